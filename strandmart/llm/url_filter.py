"""URL filter: rules by host and path, else a naive Bayes verdict over segmented names.

Names in hosts and paths are split into words by a unigram Viterbi search: the lexicon's words cost their negative log share, and other
letters cost more the longer they are.  The lexicon is the labelled names below and every word of ``LEAST_LETTERS`` to ``MOST_LETTERS`` letters that
stands alone ``LEAST_COUNT`` times or more in the URLs (and texts, where given) of the table; a word that more frequent words make up is left to be split.
A multinomial naive Bayes model, fitted on the labelled names, scores the words.

The lexicon is a table and stays one, whatever its size.  Each distinct name that holds a labelled word (no other can have a score) is joined with the
words of the lexicon among its parts and split by these alone, which gives the same split as the whole lexicon would.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged on no words (allowed); repeated
rows are judged one by one; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmart.llm.tables import written


class Rule(NamedTuple):
    verdict: str
    prefix: str  # host/path


# Labelled names, the model's training rows.
BLOCKED_NAMES = (
    "casino win, casino bonus, free bets, online bets, poker win, slots jackpot, cheap pills, buy pills, cheap viagra, online pharmacy pills, "
    "adult xxx, adult cams, hot adult video, xxx video, porn tube, sex cams, spam farm, link farm, seo spam, ads track, ads server, track click, "
    "click ads, pop ads, free money win, get rich fast, crypto win free, replica watches cheap, payday loan fast, escort girls, malware warez crack, "
    "gambling betting, gambling site, gambling odds, betting odds, betting wins, roulette blackjack, roulette table, blackjack roulette, "
    "lottery toto, lottery jackpot, lottery numbers, toto togel, toto slots, baccarat slot, slots spins, viagra cialis, viagra online, cialis pharmacy, "
    "cialis online, hot singles, singles hookup, dating singles, dating hookup, nude webcam, nude cams, webcam girls, erotic sex, sex cams, sex clips, "
    "escort sex, escort agency, escorts tonight, torrent movies, torrent download, torrent keygen, keygen serial, keygen download, cracked nulled, phishing login, "
    "phishing mail, hacked phishing, spyware virus, bitcoin doubler, bitcoin giveaway, rolex replica, replica rolex, fake watches, fake passport, "
    "pills shop, adult shop, replica store, casino club, casino city, poker club, slots house, instant loans, loans fast, payday loans, clickbait popunder, backlinks traffic, xxx clips, poker chips, pokies casino"
)
ALLOWED_NAMES = (
    "press news, daily news, science lab, travel diary, city library, open library, school math, university research, health clinic, music store, "
    "book shop, garden home, weather today, sports club, history museum, photo art, code docs, dev tools, data wiki, family recipes, bike shop, "
    "law office, public radio, film review, game guide, job market, car parts, food market, green energy, help forum, "
    "school teachers, kids learning, church parish, county council, railway station, mountain hiking, river valley, cooking kitchen, software engineering, "
    "open source, data research, academy college, hospital nursing, theatre opera, gallery painting, football league, garden plants, animal rescue, "
    "housing rent, energy institute, journal archive, maps atlas, language grammar, physics chemistry, bank insurance, hotel travel, community center, "
    "hotel booking, gift shop, coffee shop, video lessons, live concert, chess club, agency planning, table tennis, student login, online course"
)
#: Weight of a word seen once more in each class, log-odds that a URL with no known word starts from, and log cost of a strange letter.
SMOOTHING, START, LETTER_COST, STRANGE_COST = 0.5, -1.5, 3.2, 4.0

#: Letters and count from which a word of the table is one of the lexicon, and letters beyond which a run of them is no word.
LEAST_LETTERS, LEAST_COUNT, MOST_LETTERS = 3, 5, 32

URL = re.compile(r"^.*?://([^/?#]*)([^?#]*)", re.DOTALL)
ASCII_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
NAME = re.compile(r"[a-z]+")


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path."""
    m = URL.match(url) if url else None
    return (m[1].translate(ASCII_LOWER), m[2]) if m else ("", "")


def fitting(host: str, path: str, rules: dict[str, list[Rule]]) -> Rule | None:
    """The longest rule whose host is the host or one of its parents and whose path begins the path."""
    best, at = None, 0
    while host:
        for rule in rules.get(host[at:], ()):
            if path.startswith(rule.prefix[len(host) - at :]) and (best is None or len(rule.prefix) > len(best.prefix)):
                best = rule
        at = host.find(".", at) + 1
        if not at:
            break
    return best


def by_host(rules: tuple[Rule, ...]) -> dict[str, list[Rule]]:
    found: dict[str, list[Rule]] = {}
    for rule in rules:
        found.setdefault(rule.prefix.split("/", 1)[0], []).append(rule)
    return found


def examples() -> list[tuple[list[str], bool]]:
    """Training rows: words and whether they are blocked."""
    return [(row.split(), blocked) for names, blocked in ((BLOCKED_NAMES, True), (ALLOWED_NAMES, False)) for row in names.split(", ")]


def _made_up(word: str, counted: dict[str, int], labelled: dict[str, int]) -> bool:
    """Whether a word is two or more words of the lexicon, each labelled or more frequent than itself."""
    reached = [True] + [False] * len(word)
    for end in range(LEAST_LETTERS, len(word) + 1):
        for start in range(end - LEAST_LETTERS + 1):
            part = word[start:end]
            if reached[start] and part != word and (part in labelled or counted.get(part, 0) > counted[word]):
                reached[end] = True
                break
    return reached[-1]


class Model:
    """Word costs for the segmentation and log-odds of the words."""

    def __init__(self, counts: dict[str, int]) -> None:
        rows = examples()
        lexicon = Counter(w for words, _ in rows for w in words)
        counted = {w: counts.get(w, 0) + lexicon[w] for w in {*counts, *lexicon}}
        counted = {w: n for w, n in counted.items() if w in lexicon or not _made_up(w, counted, lexicon)}
        self.use(counted, sum(counted.values()))
        seen = {k: Counter(w for words, b in rows if b is k for w in words) for k in (True, False)}
        size = {k: sum(c.values()) + SMOOTHING * len(lexicon) for k, c in seen.items()}
        self.odds = {w: math.log((seen[True][w] + SMOOTHING) / size[True]) - math.log((seen[False][w] + SMOOTHING) / size[False]) for w in lexicon}

    def use(self, counted: dict[str, int], total: int) -> None:
        """Take these words of a lexicon whose counts sum to ``total``."""
        self.cost = {w: -math.log(n / total) for w, n in counted.items()}
        self.longest = max(map(len, self.cost), default=0)

    def split(self, name: str) -> list[str]:
        """The cheapest split of a lower-case name into words of the lexicon and strange stretches."""
        best: list[tuple[float, int, bool]] = [(0.0, 0, True)]
        for end in range(1, len(name) + 1):
            # a strange letter goes on with a strange stretch, or begins one
            options = [(best[end - 1][0] + LETTER_COST + (STRANGE_COST if best[end - 1][2] else 0), end - 1, False)]
            for start in range(max(0, end - self.longest), end):
                if (cost := self.cost.get(name[start:end])) is not None:
                    options.append((best[start][0] + cost, start, True))
            best.append(min(options))
        words, end, stretch = [], len(name), ""
        while end:
            _, start, known = best[end]
            if known:
                words += [stretch, name[start:end]] if stretch else [name[start:end]]
                stretch = ""
            else:
                stretch = name[start:end] + stretch
            end = start
        return [w for w in (*words, stretch) if w][::-1]

    def score_of(self, name: str) -> float:
        """Log-odds of a name's words; none of a name that is mostly strange letters, where a word is there by chance."""
        words = self.split(name)
        if 2 * sum(len(w) for w in words if w in self.cost) <= len(name):
            return 0.0
        return sum(self.odds.get(w, 0.0) for w in words)

    def score(self, host: str, path: str) -> float:
        """Log-odds of blocking."""
        return START + sum(map(self.score_of, NAME.findall(f"{host} {path}".translate(ASCII_LOWER))))


def lexicon(urls: DataFrame, url_col: str = "url", text_cols: tuple[str, ...] = ()) -> DataFrame:
    """``word`` and ``count``: how often each word of the labelled names, and each other frequent word, stands alone in the URLs (and texts)."""
    labelled = sorted({w for words, _ in examples() for w in words})
    both: Column = F.lower(F.concat_ws(" ", *(F.col(f"`{c}`") for c in (url_col, *text_cols))))
    words = urls.select(F.explode(F.split(both, r"[\P{L}]+")).alias("word")).where(F.col("word").rlike("^[a-z]+$"))
    often = F.length("word").between(LEAST_LETTERS, MOST_LETTERS) & (F.col("count") >= LEAST_COUNT)
    return words.groupBy("word").count().where(F.col("word").isin(labelled) | often)


def word_counts(urls: DataFrame, url_col: str = "url", text_cols: tuple[str, ...] = ()) -> dict[str, int]:
    """The lexicon of a small table as a dictionary, for a ``Model`` of its own."""
    return {r["word"]: r["count"] for r in lexicon(urls, url_col, text_cols).collect()}


def _with_parts(words: DataFrame, name: str, lexicon: DataFrame) -> DataFrame:
    """Each distinct ``name`` with the words of the lexicon among its parts, as ``parts``."""
    n = F.length(name)
    places = words.select(name, F.explode(F.sequence(F.lit(1), n - LEAST_LETTERS + 1)).alias("at"))
    longest = F.least(F.lit(MOST_LETTERS), n - F.col("at") + 1)
    pieces = places.select(name, "at", F.explode(F.sequence(F.lit(LEAST_LETTERS), longest)).alias("n"))
    cut = pieces.select(name, F.substr(name, "at", "n").alias("word")).distinct()
    found = cut.join(lexicon.select("word", "count", "labelled"), "word")
    return found.groupBy(name).agg(F.collect_list(F.struct("word", "count", "labelled")).alias("parts"))


def _own_lexicon(counted: DataFrame) -> DataFrame:
    """``word``, ``count`` and ``labelled`` of the lexicon: counts of the table and of the labelled rows, without words that others make up."""
    rows = Counter(w for words, _ in examples() for w in words)
    own = counted.sparkSession.createDataFrame(sorted(rows.items()), "word string, count long").withColumn("labelled", F.lit(True))
    both = counted.withColumn("labelled", F.lit(False)).unionByName(own).groupBy("word").agg(F.sum("count").alias("count"), F.max("labelled").alias("labelled"))
    both = written(both, "words")
    others = _with_parts(both.where(~F.col("labelled") & (F.length("word") >= 2 * LEAST_LETTERS)).select(F.col("word").alias("name")), "name", both)

    def check(batches):
        for batch in batches:
            made = []
            for name, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = {p["word"]: p["count"] for p in parts}
                if _made_up(name, counts, {p["word"]: 1 for p in parts if p["labelled"]}):
                    made.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["word"])

    return both.join(others.mapInArrow(check, "word string"), "word", "left_anti")


def name_scores(names: DataFrame, counted: DataFrame) -> DataFrame:
    """``name`` and ``score`` (log-odds of its words) of the distinct names whose score is not zero."""
    words = written(_own_lexicon(counted), "lexicon")
    total = words.agg(F.sum("count")).first()[0]
    distinct = names.where(F.col("name").rlike("|".join(_labelled()))).select("name").distinct()

    def score(batches):
        model = Model({})
        for batch in batches:
            rows = []
            for name, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                model.use({p["word"]: p["count"] for p in parts}, total)
                if (found := model.score_of(name)) != 0:
                    rows.append((name, found))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())], ["name", "score"])

    return _with_parts(distinct, "name", words).mapInArrow(score, "name string, score double")


def _labelled() -> list[str]:
    """The labelled words, those that begin with another one left out."""
    words = sorted({w for row, _ in examples() for w in row})
    return [w for w in words if not any(w != v and v in w for v in words)]


def judged(
    urls: DataFrame, rules: tuple[Rule, ...] = (), id_col: str = "page_id", url_col: str = "url", counted: DataFrame | None = None,
    text_cols: tuple[str, ...] = (),
) -> DataFrame:
    """``id_col``, host, path, rule (null without one), score (log-odds of blocking by the model) and verdict.

    ``counted`` (``word``, ``count``) may stand in for the table's own lexicon.
    """
    counted = lexicon(urls, url_col, text_cols) if counted is None else counted
    slim = urls.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.monotonically_increasing_id().alias("row"))
    kind = slim.schema["id"].dataType.simpleString()
    hosts = by_host(rules)
    holds = re.compile("|".join(_labelled()))

    def read(batches):
        for batch in batches:
            rows = []
            for url in batch.column(1):
                host, path = parts(url.as_py())
                rule = fitting(host, path, hosts)
                names = [n for n in NAME.findall(f"{host} {path}".translate(ASCII_LOWER)) if holds.search(n)]
                rows.append((host, path, rule.prefix if rule else None, rule.verdict if rule else None, names))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["id", "row", "host", "path", "rule", "ruled", "names"]
            )

    parsed = written(slim.mapInArrow(read, f"id {kind}, row long, host string, path string, rule string, ruled string, names array<string>"), "urls")
    named = parsed.select("row", F.explode("names").alias("name"))
    scores = written(name_scores(named, counted), "name-scores")
    sums = named.join(scores, "name").groupBy("row").agg(F.sum("score").alias("found"))
    score = F.lit(START) + F.coalesce("found", F.lit(0.0))
    verdict = F.coalesce("ruled", F.when(score > 0, "block").otherwise("allow"))
    return parsed.join(sums, "row", "left").select(F.col("id").alias(id_col), "host", "path", "rule", score.alias("score"), verdict.alias("verdict"))
