"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A tokenizer's vocabulary holds what text repeats, so words and names take few tokens, while random strings fall into one or two
characters a token.  Long strings at or below a ratio of characters per token are reported, after digests of known lengths, UUIDs, numbers and
names whose parts encode as words have been set aside.  Shorter strings need a lower ratio, as a single long word can come near two.

Defined results: a null text counts as an empty one and has no spans; repeated rows are scanned one by one; an empty table gives
an empty one.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

# The base patterns and the least lengths of what they match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run is matched at its first character, so a search needs no other start.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % HEX_CHARS)

#: A random string: its least length, and the most characters that one token may stand for; and both for shorter ones.
RANDOM_CHARS, RANDOM_RATIO = 20, 2.0
SHORT_CHARS, SHORT_RATIO = 12, 1.6
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORT_CHARS)

# Lengths of hexadecimal digests (MD5, SHA-1, SHA-2), and shapes that are no secrets.
DIGEST_CHARS = frozenset((32, 40, 56, 64, 96, 128))
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
SEPARATORS = re.compile(r"[+/_=-]+")
PART = re.compile(r"([A-Za-z]*)[0-9]{0,4}|[0-9]+")
TIME = re.compile(r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[Tt_-]?[0-9]{2}-?[0-9]{2}(-?[0-9]{2})?([Zz]|[+-][0-9]{2,4})?")
# Names in front of public numbers and digests; ISBN and ISSN may end in an X.
NUMBERED = re.compile(r"(isbn|issn|ean|gtin|upc|doi|pmid|orcid|iso|rfc|cve|sku|din|iban)([0-9X_/-]*[0-9][0-9X_/-]*)", re.IGNORECASE)
NAMED_DIGEST = re.compile(r"(md5|sha1|sha256|sha384|sha512)[-=]([0-9A-Za-z+/_-]{22,128}={0,2})", re.IGNORECASE)
#: Distinct characters up to which a long run is no random string (bases of DNA, rules, repeated letters), and the share of neighbours in a row that makes an alphabet.
FEW_CHARS, IN_A_ROW = 5, 0.8
WORDS = re.compile(r"[A-Za-z]{2,}")


class Span(NamedTuple):
    start: int
    end: int
    kind: str


@lru_cache(maxsize=2)
def ranks(path: str, pattern: str) -> tiktoken.Encoding:
    """A vocabulary file as an encoding, once in a worker."""
    with open(path, "rb") as file:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=found, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns that are long enough, each kind leftmost and non-overlapping."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [Span(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [Span(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    out += [Span(*m.span(), "hex") for m in HEX.finditer(text)]
    return out


def is_word(letters: str, encoding: tiktoken.Encoding) -> bool:
    """Whether letters, or those of a capital word in lower case, are one token, or take few."""
    forms = {letters, letters.lower()} if letters.isupper() or letters.istitle() else {letters}
    n = min(len(encoding.encode_ordinary(x)) for x in forms)
    return n <= 1 or len(letters) > RANDOM_RATIO * n


def is_alphabet(run: str) -> bool:
    """Whether most characters follow the one before them, up or down."""
    steps = [ord(b) - ord(a) for a, b in zip(run, run[1:], strict=False)]
    return max(steps.count(1), steps.count(-1)) >= IN_A_ROW * len(steps)


def holds_prose(run: str, encoding: tiktoken.Encoding) -> bool:
    """Whether a run is Base64 of plain words with blanks between them."""
    body = run.rstrip("=")
    if len(body) % 4 == 1 or any(c in body for c in "_-="):
        return False
    raw = base64.b64decode(body + "=" * (-len(body) % 4))
    if not raw.isascii() or b" " not in raw:
        return False
    text = raw.decode("ascii")
    found = WORDS.findall(text)
    return text.isprintable() and sum(map(len, found)) >= 0.7 * len(text) and all(is_word(w, encoding) for w in found)


def known(run: str, encoding: tiktoken.Encoding) -> bool:
    """Digests, UUIDs, times, numbers with or without their name, alphabets, runs of few characters, prose in Base64, and names of several parts that are words (with up to four digits) or numbers."""
    if len(run) in DIGEST_CHARS and DIGEST.fullmatch(run):
        return True
    if not any(c.isalpha() for c in run) or UUID.fullmatch(run):
        return True
    if TIME.fullmatch(run) or NUMBERED.fullmatch(run) or NAMED_DIGEST.fullmatch(run) or len(set(run)) <= FEW_CHARS or is_alphabet(run) or holds_prose(run, encoding):
        return True
    parts = [PART.fullmatch(p) for p in SEPARATORS.split(run) if p]
    return all(parts) and all(is_word(m[1], encoding) for m in parts if m[1])


def spans(text: str | None, encoding: tiktoken.Encoding, ratio: float = RANDOM_RATIO) -> list[Span]:
    """All spans by start and kind; a random string inside or across a base span is that span's."""
    if not text:
        return []
    base = base_spans(text)
    more = []
    for m in RUN.finditer(text):
        a, b = m.span()
        if any(s.start < b and a < s.end for s in base) or known(m[0], encoding):
            continue
        most = ratio if b - a >= RANDOM_CHARS else min(ratio, SHORT_RATIO)
        if b - a <= most * len(encoding.encode_ordinary(m[0])):
            more.append(Span(a, b, "random"))
    return sorted(base + more, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def scanned(docs: DataFrame, path: str, pattern: str, ratio: float = RANDOM_RATIO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans``: an array of (kind, start, end), empty for a clean text."""
    slim = docs.select(id_col, text_col)
    kind = slim.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        encoding = ranks(path, pattern)
        for batch in batches:
            rows = [[{"kind": s.kind, "start": s.start, "end": s.end} for s in spans(t.as_py(), encoding, ratio)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, item)], [id_col, "spans"])

    return slim.mapInArrow(scan, f"`{id_col}` {kind}, spans array<struct<kind: string, start: long, end: long>>")


def redacted(text: str | None, found: list[Span]) -> str | None:
    """The text with each stretch of overlapping spans replaced by the kind of its first one in brackets."""
    if not found:
        return text
    out, at, end, kind = [], 0, -1, ""
    for s in found:
        if s.start >= end:
            if end >= 0:
                out.append(f"[{kind}]")
                at = end
            out.append(text[at : s.start])
            end, kind = s.end, s.kind
        else:
            end = max(end, s.end)
    return "".join([*out, f"[{kind}]", text[end:]])


def redacted_documents(docs: DataFrame, path: str, pattern: str, ratio: float = RANDOM_RATIO, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret of the text column replaced; all rows and columns stay, and a null text stays null."""
    place = docs.columns.index(text_col)

    def redact(batches):
        encoding = ranks(path, pattern)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(place)]
            new = pa.array([redacted(t, spans(t, encoding, ratio)) for t in texts], pa.string())
            yield batch.set_column(place, batch.schema.field(place).name, new)

    return docs.mapInArrow(redact, docs.schema)
