"""Quality rules, secret scan, pseudonyms and decontamination, against brute force and planted cases."""

import datetime
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from strandmart.llm import decontaminate, pii, quality, secret_scan
from strandmart.session import tune
from tests.llm.cases import TEXTS, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k : k + 8])].append(k)
    covered = {j for v in places.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    rng = random.Random(1)
    made = []
    for k in range(60):
        words = rng.choices("abcdef", k=rng.randint(0, 80)) if k % 2 else rng.choices([f"w{j}" for j in range(500)], k=rng.randint(0, 80))
        if k % 3 == 0:
            words = words + words[: rng.randint(0, 40)] + ["#|"] + words
        made.append((100 + k, "".join(w + rng.choice([" ", "\n", "\t ", "\n\n"]) for w in words)))
    rows = [*TEXTS, *made]
    got = quality.judged(documents(tune(spark), rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(str((r.doc_id, *(r[n] for n in names))) for r in got) == sorted(str((i, *brute_measures(t))) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed) and r.kept == (r.reason is None)
    assert quality.judged(documents(spark).limit(0)).count() == 0


def test_quality_keeps_clean_rows_whole(spark):
    clean = "The house of the man is in the city and the people of the city are at home, as it was for them in all of those good years."
    docs = documents(spark, [(1, clean), (2, "### *** " * 30), (3, None), (1, clean)])
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1, 1]


def test_secret_spans():
    encoding = secret_scan.ranks(RANKS, public_tokenizers.PATTERN)
    kinds = lambda text: [(s.kind, text[s.start : s.end]) for s in secret_scan.spans(text, encoding)]
    assert kinds('ü PassWord: "abcdefghijkl" x') == [("assign", 'PassWord: "abcdefghijkl')]
    assert kinds("token=short AKIA1234 deadbeef") == []
    assert kinds("AKIA" + "A1" * 7 + " x") == [("access", "AKIA" + "A1" * 7)]
    assert kinds("id 0123456789abcdef0 z") == [("hex", "0123456789abcdef0")]
    assert kinds("see qX7vT9zLkP2mWb4NcY8sRd1H now") == [("random", "qX7vT9zLkP2mWb4NcY8sRd1H")]
    for harmless in ("internationalization_of_all_things", "A" * 40, "D41D8CD98F00B204E9800998ECF8427E", "3F2504E0-4F89-11D3-9A0C-0305E82C3301", "2024-01-01-12-30-45-000001"):
        assert kinds(harmless) == []
    assert secret_scan.redacted("a token=abcdefghijklmnop b", secret_scan.spans("a token=abcdefghijklmnop b", encoding)) == "a [assign] b"


def test_random_strings_of_any_letters():
    encoding = secret_scan.ranks(RANKS, public_tokenizers.PATTERN)
    kinds = lambda text: [(s.kind, text[s.start : s.end]) for s in secret_scan.spans(text, encoding)]
    for run in ("QxZkVpLtRwNbHsGjMfYc", "QxZkVpLtRwNbHsGjMfYc42", "sk_XqZvKpWtRbNcLmGh_83920174", "qxzkvpltrwnbhsgjmfyc", "qX7vT9zLkP2mWb"):
        assert kinds(f"see {run} now") == [("random", run)]
    rng = random.Random(11)
    # short runs of lower case alone can be words, so about half of these are found
    for letters, short in (("abcdefghijklmnopqrstuvwxyz", 0.4), ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.85)):
        for low, high, least in ((20, 64, 0.97), (12, 19, short)):
            runs = ["".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(400)]
            assert sum(kinds(r) == [("random", r)] for r in runs) >= least * len(runs)
    for harmless in ("get_user_by_id_2024_01_02_a_b", "MAX_BUFFER_SIZE_LIMIT_2", "Donaudampfschifffahrtsgesellschaft", "getElementByIdFromDocument", "2024-01-01-12-30-45"):
        assert kinds(harmless) == []


def test_secret_columns(spark):
    docs = documents(spark, [*TEXTS, (50, "secret=abcdefghijklmno and deadbeefdeadbeef0")])
    got = {r.doc_id: r.spans for r in secret_scan.scanned(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert [s.kind for s in got[50]] == ["assign", "hex"] and all(not got[k] for k in (2, 3, 4, 5))
    clean = secret_scan.redacted_documents(docs, RANKS, public_tokenizers.PATTERN)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[50] == "[assign] and [hex]" and texts[2] is None and texts[6] == dict(TEXTS)[6]
    assert secret_scan.redacted_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark):
    text = (
        "a@b.co jo.doe7@x.example.org 4111 1111 1111 1111 4111-1111-1111-1112 123-45-6789 666-45-6789 +1 (743) 555-3824 "
        "10.0.0.255 999.1.1.1 2024-02-29 2024-02-30 31.12.1999 12/25/2001 13/25/2001"
    )
    docs = documents(tune(spark), [*TEXTS, (60, text), (61, f"é{text}, {text}")])
    made = pii.pseudonymised(docs, "k")
    rows = {r.doc_id: r for r in made.collect()}
    assert made.columns == [*docs.drop("pii").columns, "pii"]
    found = {x.value: x.pseudonym for x in rows[60].pii}
    assert len(found) == 9 and not set(found) & {"4111-1111-1111-1112", "666-45-6789", "999.1.1.1", "2024-02-30", "13/25/2001"}
    replaced = " ".join(found.get(w, w) for w in re.split(r" (?!1111|\(743|555)", text))
    assert rows[60].text == replaced and rows[61].text == f"é{replaced}, {replaced}"
    new = found["4111 1111 1111 1111"]
    assert re.fullmatch(r"4\d{3} \d{4} \d{4} \d{4}", new) and luhn(new.replace(" ", "")) and new != "4111 1111 1111 1111"
    datetime.date.fromisoformat(found["2024-02-29"])
    datetime.datetime.strptime(found["31.12.1999"], "%d.%m.%Y")
    datetime.datetime.strptime(found["12/25/2001"], "%m/%d/%Y")
    assert re.fullmatch(r"\+1 \(743\) [2-9]\d\d-\d{4}", found["+1 (743) 555-3824"]) and found["jo.doe7@x.example.org"].endswith("@x.example.org")
    assert {k: rows[k].text for k in (1, 2, 3, 5)} == {k: dict(TEXTS)[k] for k in (1, 2, 3, 5)}


def test_feistel_permutes(spark):
    n = spark.range(7 * 11).select(pii.feistel("key", "t", F.floor(F.col("id") / 11), F.pmod("id", F.lit(11)), 7, 11).alias("x"))
    pairs = {(r.x.a, r.x.b) for r in n.collect()}
    assert pairs == {(a, b) for a in range(7) for b in range(11)}
    other = spark.range(7 * 11).select(pii.feistel("other", "t", F.floor(F.col("id") / 11), F.pmod("id", F.lit(11)), 7, 11).alias("x")).collect()
    assert [r.x for r in other] != [r.x for r in n.collect()]


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_words_are_longest():
    import numpy as np

    rng = random.Random(2)
    for _ in range(200):
        a, b = (np.array(rng.choices(range(6), k=rng.randint(1, 12))) for _ in range(2))
        common, _ = decontaminate.common_words(a, b)
        assert len(common) == brute_lcs(a.tolist(), b.tolist())


def test_leaks_exact_and_changed(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(3000)]
    draw = lambda n: [words[min(int(rng.expovariate(0.003)), 2999)] for _ in range(n)]
    items = [draw(rng.choice([10, 25, 45, 70])) for _ in range(30)]
    rows, want = [], set()
    for k in range(300):
        text = draw(rng.randint(50, 400))
        if k % 10 == 0:
            item = k // 10 % 30
            at = rng.randint(0, len(text))
            leak = list(items[item])
            if k % 20 == 0 and len(leak) > 20:
                leak[5:6] = ["paraphrased", "here"]
                del leak[12]
            text[at:at] = leak
            want.add((k, item))
        rows.append((k, " ".join(text).capitalize()))
    bench = spark.createDataFrame([*((k, " ".join(i) + ".") for k, i in enumerate(items)), (98, None), (99, " ")], "item_id long, text string")
    docs = documents(spark, [*rows, *TEXTS[1:5]])
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(r.common >= 0.65 for r in got)
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_leak_without_its_rarest_word_at_two_corpus_sizes(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(3000)]
    draw = lambda n: [words[min(int(rng.expovariate(0.005)), 2999)] for _ in range(n)]
    items = [draw(40) for _ in range(10)]
    bench = spark.createDataFrame([(k, " ".join([*i[:20], f"unique{k}", *i[20:]])) for k, i in enumerate(items)], "item_id long, text string")
    for n in (100, 3000):
        rows = [(k, " ".join([*draw(60), *(items[k][:20] + ["other"] + items[k][20:] if k < 10 else []), *draw(60)])) for k in range(n)]
        got = decontaminate.contaminated(documents(spark, rows), bench).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(k, k) for k in range(10)}


def test_very_long_texts_of_every_kind_get_pseudonyms(spark):
    n = 1_000_000
    long = {
        1: "x@" + "a." * (n // 2) + "com", 2: "x@" + "a" * n, 3: "a" * n + "@b.com", 4: "4111 " * (n // 5), 5: "123-45-" * (n // 7), 6: "1." * (n // 2), 7: "(555) " * (n // 6), 8: "2020-01-" * (n // 8),
        9: "a@" * (n // 2), 10: "me@site.org " + "z" * n, 11: "x@a..com y@b.c-d.org. " * 1000,
    }
    docs = spark.createDataFrame(list(long.items()), "doc_id long, `my.text` string")
    made = {r.doc_id: r["my.text"] for r in pii.pseudonymised(docs, "k", text_col="my.text").collect()}
    assert all(len(made[k]) == len(v) for k, v in long.items())
    assert made[1].endswith("a.com") and made[1] != long[1] or made[1][1:] == long[1][1:]
    assert made[3] == long[3] and not made[10].startswith("me@") and made[10][2:] == long[10][2:]


def test_pseudonyms_equal_a_second_writing_of_the_patterns(spark):
    email = re.compile(r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", re.ASCII)
    ssn = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
    rng = random.Random(12)
    bits = ["ann@site.org", "bob.b+c@mail.a-b.co", "@x.y", "a@b", "123-45-6789", "666-12-1234", "900-11-1111", "000-11-1111", "10.0.0.1", "word", ".", ",", "12"]
    docs = [(k, " ".join(rng.choices(bits, k=12))) for k in range(200)]
    made = {r.doc_id: r for r in pii.pseudonymised(spark.createDataFrame(docs, "doc_id long, text string"), "k").collect()}
    for k, text in docs:
        found = [(x.kind, x.value) for x in made[k].pii]
        assert [v for kind, v in found if kind == "email"] == email.findall(text)
        assert [v for kind, v in found if kind == "ssn"] == ssn.findall(text)
        put = text
        for x in made[k].pii:
            assert x.pseudonym != x.value or x.kind == "email" and len(x.value.split("@")[0]) < 2
            put = put.replace(x.value, "\0" + x.pseudonym + "\0") if x.value in put else put
        assert put.replace("\0", "") == made[k].text or len({v for _, v in found}) < len(found)


def test_identifiers_are_no_secrets():
    encoding = secret_scan.ranks(RANKS, public_tokenizers.PATTERN)
    clean = (
        "2024-01-01T00-00-00 20240101T000000Z ISBN-978-3-16-148410-0 978-3-16-148410-X abcdefghijklmnopqrstuvwxyz ZYXWVUTSRQPONMLKJIHGFEDCBA GATTACAGATTACAGATTACA "
        "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU= xXxXxXxXxXxXxXxXxX VGhlIGhvdXNlIG9mIHRoZSBtYW4gaXMgaW4gdGhlIGNpdHk= CVE-2024-12345 0123456789 550e8400-e29b-41d4-a716-446655440000"
    ).split()
    assert [(c, secret_scan.spans(c, encoding)) for c in clean if any(s.kind == "random" for s in secret_scan.spans(c, encoding))] == []
    rng = random.Random(3)
    for letters, length, least in (("abcdefghijklmnopqrstuvwxyz", 24, 0.9), ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 0.9), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32, 0.9)):
        made = ["".join(rng.choices(letters, k=length)) for _ in range(500)]
        assert sum(bool(secret_scan.spans(f"see {x} now", encoding)) for x in made) >= least * len(made)


def test_base_spans_equal_a_second_writing():
    encoding = secret_scan.ranks(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(9)
    bits = ["password", "ApiKey", "api_key", "Secret", "token", "=", ":", " ", '"', "'", "AKIA", "ABC9", "0f", "deadbeef", "x_", "ü", "+/", "-"]

    def brute(text):
        at, out = 0, []
        while m := re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?[ ]*[:=][ ]*[\"']?([A-Za-z0-9+/_.=-]+)").search(text, at):
            out += [("assign", m.start(), m.end())] if len(m[1]) >= 12 else []
            at = m.end()
        out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))

    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert [(s.kind, s.start, s.end) for s in secret_scan.spans(text, encoding) if s.kind in secret_scan.BASE_KINDS] == brute(text), text


def test_contaminated_equals_all_pairs(spark, monkeypatch):
    """Every document against every item by the longest common subsequence over all regions, without the latent search."""
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 12)  # several blocks
    monkeypatch.setattr(decontaminate, "TILE_QUERIES", 3)
    monkeypatch.setattr(decontaminate, "TILE_WINDOWS", 5)
    rng = random.Random(15)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 7))) for _ in range(2000)]
    draw = lambda n: rng.choices(words, k=n)
    items = [draw(rng.choice([14, 30, 60, 200])) for _ in range(16)]
    rows = []
    for k in range(80):
        text = draw(rng.randint(20, 120))
        if k % 3 == 0:
            leak = list(items[k % 16])
            for _ in range(rng.choice([0, 1, len(leak) // 12, len(leak) // 2])):
                leak[rng.randrange(len(leak))] = rng.choice(words)
            at = rng.randint(0, len(text))
            text[at:at] = leak
        rows.append((k, " ".join(text)))
    bench = spark.createDataFrame([(f"i{k}", " ".join(i)) for k, i in enumerate(items)] + [("again", " ".join(items[3])), (None, " ".join(items[6])), ("none", None)], "item_id string, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark, rows), bench).collect()}
    want = set()
    for k, text in rows:
        for j, item in enumerate(items):
            n, found = len(item), text.split()
            share = max((brute_lcs(item, found[a : a + n + 64]) for a in range(0, max(1, len(found) - n), 16)), default=0) / n
            if share >= (0.9 if n <= 12 else 0.65):
                want |= {(k, name) for name in (f"i{j}", *(["again"] if j == 3 else []), *([None] if j == 6 else []))}
    # the answer, half of which must be there, is the whole item here: one sentence
    assert got == want and len(want) > 15


def test_long_and_repeated_items(spark):
    rng = random.Random(16)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(5000)]
    long = [" ".join(rng.choices(words, k=3000)) for _ in range(6)]
    short = " ".join(rng.choices(words, k=30))
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(long)] + [(100 + k, short) for k in range(3000)], "item_id long, text string")
    docs = documents(spark, [(1, f"{short} {long[2]} end"), (2, " ".join(rng.choices(words, k=500))), (3, short)])
    got = decontaminate.contaminated(docs, bench).groupBy("doc_id").agg(F.count("*").alias("n"), F.min("item_id").alias("low")).collect()
    assert {(r.doc_id, r.n, r.low) for r in got} == {(1, 3001, 2), (3, 3000, 100)}


def test_words_are_the_same_by_either_pattern():
    for text in ("Ünïcödé wörds_and 12½ ª² x", "Ελλάδα and ümlaut_x", "", None, " _ ", "".join(map(chr, range(1, 700)))):
        assert decontaminate.words(text) == re.findall(r"[^\W_]+", (text or "").lower())
    assert decontaminate.words("".join(map(chr, range(1, 256)))) == re.findall(r"[^\W_]+", "".join(map(chr, range(1, 256))).lower())


def test_latin_texts_are_coded_without_a_search_for_each(monkeypatch):
    chars = "".join(map(chr, range(1, 256)))
    texts = [None, "", " ", "_-", "One two_three, one", "  lead\x85trail\xa0", chars, "Kelvin one", "Stra\xdfe ẞ one", "一 one İ", "one\x00two", "Ÿ \xff ONE"]
    vocabulary = {w: k for k, w in enumerate(["one", "一", "two", "stra\xdfe", "\xff", "kelvin", "trail", "\xb2\xb3"])}
    for width in ("<u2", "<u4"):
        got = decontaminate.Coder(vocabulary, width).of(texts)
        assert [np.frombuffer(x, width).tolist() for x in got] == [[vocabulary.get(w, 8) for w in decontaminate.words(t)] for t in texts]
    assert decontaminate.Coder({"一": 0}, "<u2").of(["a 一", "b"]) == [b"\1\0\0\0", b"\1\0"]
    assert decontaminate.Coder(vocabulary, "<u2").of([]) == [] and decontaminate.Coder(vocabulary, "<u2").of([None]) == [b""]
    monkeypatch.setattr(decontaminate, "words", None)
    decontaminate.Coder(vocabulary, "<u2").of([chars, "One", None])


def test_sums_of_codes_and_near_windows_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 7)
    monkeypatch.setattr(decontaminate, "TILE_COSINES", 4)
    rng = np.random.default_rng(3)
    rows, basis = rng.integers(0, 31, (50, decontaminate.HALF)), rng.standard_normal((31, 5)).astype(np.float32)
    for share in (0, 0.2, 0.6, 1):
        used = rng.random(31) < share
        plain = np.where(used[rows][:, :, None], basis[rows].astype(float), 0).sum(axis=1)
        made = decontaminate._projected(rows, basis, used)
        assert made.dtype == np.float32 and np.allclose(made, plain, atol=1e-5)
    places, starts = rng.integers(0, 50, 200), np.array([0, 1, 60, 199])
    assert (decontaminate._sums(made, places, starts) == np.add.reduceat(made[places], starts, axis=0)).all()
    queries, least = rng.standard_normal((5, 6)).astype(np.float32), np.linspace(0, 3, 6, dtype=np.float32)
    cosine = made @ queries
    w, q = np.nonzero(cosine >= least)
    a, b, c = decontaminate._near(made, queries, least)
    assert (a == w).all() and (b == q).all() and np.allclose(c, cosine[w, q], atol=1e-5) and 0 < len(w) < 300
