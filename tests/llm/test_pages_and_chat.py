"""Page text, URL filter and chat formatting."""

import hashlib
import random
import time

import pytest

from strandmart.llm import chat, html_text, url_filter
from strandmart.llm.page_layouts import labelled_pages
from strandmart.llm.queries import URL_RULES, op10_chat_format


@pytest.fixture(scope="module")
def trees():
    return html_text.model()


def test_held_out_layouts(trees):
    exact = 0
    pages = list(labelled_pages(150, 77))
    for source, main in pages:
        page = html_text.Page(source)
        kept = {page.text[k] for k in html_text.decode(page, html_text.scored([page], trees)[0])}
        exact += kept == {t for t in page.text if t in main}
    assert exact >= 0.9 * len(pages)


def test_page_columns(spark, trees):
    body = "<article><h1>A title of it</h1><p>First &amp; best\n  part of the <b>article</b>, long enough to be read.<p>Second <i>part</i><br>goes on here, and on.</article>"
    source = f"<html><head><title>T</title><script>var x='</p>'</script></head><body><nav><ul><li><a href=/a>A</a></li></ul></nav>{body}<footer>&copy; x</footer>"
    rows = [(1, "u", source), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "just words"), (5, "u", "<" * 50 + "p>&#x41;"), (6, "u", source + "<p>" * 3000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.main_text(frame, trees).collect()
    want = "A title of it\n\nFirst & best part of the article, long enough to be read.\n\nSecond part goes on here, and on."
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and texts[1] == want and texts[2] == texts[3] == "" and all(r.n_chars == len(r.text) for r in got)
    assert html_text.main_text(frame.limit(0), trees).count() == 0


def brute_rule(host, path):
    best = None
    for rule in URL_RULES:
        name, _, rest = rule.prefix.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule.prefix) > len(best.prefix)):
            best = rule
    return best


def test_url_rules_and_model(spark):
    urls = [
        "https://A.example.org/es/x?y#z", "http://example.org/en/12", "ftp://org", "http://org/", "x://b.com/fr/1", "x://com/de/", "http://www.cheappills.net/", None, "no scheme",
        "http://citylibrary.net/blog", "http://ÄB.Example.com/FR/?a", "http://h?q://x", "http://notorg.example.net/", "http://free-bets.casino.net/win", "http://the.example.net/", "",
    ]
    frame = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judged(frame, URL_RULES).collect()}
    assert len(got) == len(urls) + 1
    for k, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
            path = rest[cut:].split("?")[0].split("#")[0]
        rule = brute_rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule.prefix if rule else None)
        if rule:
            assert got[k].verdict == rule.verdict
    assert [got[k].verdict for k in (6, 9, 13, 14, 7)] == ["block", "allow", "block", "allow", "allow"]
    assert url_filter.judged(frame.limit(0), URL_RULES).count() == 0


def test_segmentation_splits_names():
    model = url_filter.Model({})
    assert model.split("casinobonus") == ["casino", "bonus"] and model.split("qqzzy") == ["qqzzy"] and model.split("") == []
    held_out = [("freepills", True), ("adultvideo", True), ("winjackpot", True), ("cityweather", False), ("sciencebook", False), ("musicclub", False)]
    assert all((model.score(f"{n}.example.com", "/") > 0) == blocked for n, blocked in held_out)


def test_trees_of_replies(spark):
    nodes = [
        (1, 1, None, "user", "hi <b>", 0.0), (1, 2, 1, "assistant", "yes \\l", 1.0), (1, 3, 1, "assistant", "no", 5.0), (1, 4, 2, "user", None, 9.0), (1, 5, 3, None, "</turn>", 0.0),
        (None, 1, None, "user", "alone", None), (2, 7, 8, "user", "cycle", 0.0), (2, 8, 7, "user", "cycle", 0.0), (3, 1, 99, "assistant", "orphan", 0.0),
    ]
    frame = spark.createDataFrame([(*n, "x") for n in nodes], "tree long, node long, parent long, role string, text string, score double, leaf string")
    made = chat.formatted(frame)
    got = {(r.tree, r.leaf): (r["rank"], r.back, r.loss_text) for r in made.select("tree", "leaf", "rank", chat.read_back(made.text).alias("back"), chat.under_loss(made.text, made.loss).alias("loss_text")).collect()}
    assert {k: v[0] for k, v in got.items()} == {(1, 4): 1, (1, 5): 2, (None, 1): 1, (3, 1): 1}
    assert [tuple(x) for x in got[1, 4][1]] == [("user", "hi <b>"), ("assistant", "yes \\l"), ("user", "")]
    assert [tuple(x) for x in got[1, 5][1]] == [("user", "hi <b>"), ("assistant", "no"), ("", "</turn>")]
    assert got[1, 4][2] == "yes \\l" and got[3, 1][2] == "orphan" and got[None, 1][2] == ""
    assert {r.leaf for r in chat.formatted(frame, keep=1).where("tree = 1").collect()} == {4}
    assert chat.formatted(frame.limit(0)).count() == 0


def test_long_chains(spark):
    frame = spark.createDataFrame([(1, k, k - 1 if k else None, "user", str(k), 0.0) for k in range(300)], "tree long, node long, parent long, role string, text string, score double")
    rows = chat.paths(frame).collect()
    assert sorted((r.leaf, r.node, r.back) for r in rows) == [(299, k, 299 - k) for k in range(300)]


def test_conversation_digests(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for c in range(5):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, ["user", "assistant"][t % 2], rng.choice(["a < b > c \\ d", None, "", "é\n\n<turn assistant>", "</turn>\\b"])))
    rows += [(9, 0, "assistant", "twice"), (9, 0, "assistant", "twice"), (9, None, None, "first"), (None, 0, "assistant", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in op10_chat_format(spark, str(tmp_path)).collect()}
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    for c in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for i, t, r, x in rows if i == c))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_url_words_of_the_table_are_in_the_lexicon(spark):
    rows = [(k, f"https://site{k}.org/velvet/{'lantern' if k % 2 else 'hazel'}", "a lantern, a hazel") for k in range(12)]
    rows += [(50 + k, "https://velvetlantern.com/", "") for k in range(5)] + [(99, "https://casinovelvet.com/", ""), (100, "https://hazelvelvetcasino.net/", "")]
    urls = spark.createDataFrame(rows, "page_id long, url string, html string")
    counts = url_filter.word_counts(urls)
    assert counts["velvet"] == 12 and counts["lantern"] == 6
    assert url_filter.word_counts(urls, text_cols=("html",))["lantern"] == 18
    model = url_filter.Model(counts)
    assert model.split("velvetlantern") == ["velvet", "lantern"] and model.split("hazelvelvetcasino") == ["hazel", "velvet", "casino"]
    got = {r.page_id: r.score for r in url_filter.judged(urls).collect()}
    assert got[100] > url_filter.START and got[99] > url_filter.START


def test_broken_tags_take_linear_time(trees):
    for n, least in ((20_000, 0), (200_000, 0)):
        for source in ("<i c='x " * n, "<i c='x " * n + ">", "<i c='x " * n + "'>'", "<a '\"" * n + ">x", "<" * n, "<script " * n):
            start = time.perf_counter()
            html_text.Page(source)
            assert time.perf_counter() - start < 5
    page = html_text.Page("<p title='a > b'>one <b class=\"q\">two</b></p><a href=\"three>four</a><p>five")
    assert [t for t in page.text if t] == ["one two", "four", "five"]


def test_a_page_that_is_one_form(trees):
    sentence = "The council met on Monday, and after a long debate it agreed on the plan for the new bridge over the river. "
    article = "".join(f"<p>{k}. {sentence * 3}</p>" for k in range(6))
    inner = f"<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li></ul></nav><article><h1>A bridge for the town</h1>{article}</article><form class=search><input><button>Go now</button></form><footer><p>Copyright 2024</p></footer>"
    plain, whole = (html_text.main_texts([f"<html><body>{x}</body></html>"], trees)[0] for x in (inner, f"<form id=aspnetForm action=/>{inner}</form>"))
    assert whole == plain and sentence.strip() in whole and "Go now" not in whole and "Home" not in whole


def test_table_verdicts_equal_a_model_of_the_whole_lexicon(spark):
    rng = random.Random(5)
    plain = ["velvet", "lantern", "hazel", "union", "essex", "sexton", "news", "casino", "pills", "library", "free", "zzgq"]
    rows = [(k, f"https://{''.join(rng.choices(plain, k=rng.randint(1, 3)))}.example.com/{rng.choice(plain)}/{''.join(rng.choices(plain, k=2))}?q", rng.choice(plain)) for k in range(400)]
    rows += [(None, None, None), (3, "https://" + "casino" * 300 + "/", ""), (3, rows[3][1], "")]
    urls = spark.createDataFrame(rows, "page_id long, url string, host string")
    model = url_filter.Model(url_filter.word_counts(urls, text_cols=("host",)))
    got = url_filter.judged(urls, text_cols=("host",)).collect()
    assert sorted(str((r.page_id, r.host, round(r.score, 6))) for r in got) == sorted(str((k, url_filter.parts(u)[0], round(model.score(*url_filter.parts(u)), 6))) for k, u, _ in rows)
    assert {r.verdict for r in got} == {"allow", "block"} and all((r.verdict == "block") == (r.score > 0) for r in got)


def test_names_that_are_not_in_the_list():
    """Names of sites outside the labelled ones, beside common words that a table would bring."""
    blocked = (
        "bestviagrashop hotsinglesnearyou gamblingking totowin freemoviestorrent casinoroyale megaslots onlinebettingtips cheapcialis nudewebcams keygenpro pokerstarswin "
        "instantloansnow sexchat fakerolex bitcoindoublerpro phishingkitonline xxxtubetop escortcity lotterynow viagraworld torrentking casinolab bettingstars rolexreplicashop"
    ).split()
    allowed = (
        "citylibrary schoolmathclub sciencejournal mountainhikers riverphotos countycouncil kidslearningcenter bikeshopberlin historyarchive opensourcetools cookingschool "
        "footballnews greengarden hotelparis chemistrylab railwaymuseum parishchurch universitypress weathermaps publichealth starhotel bigshop essexunion sussexcollege winterphotos"
    ).split()
    common = "best shop hot near you king free movies online tips cheap pro stars now paris city math river photos kids center berlin world big star new top mega royale essex sussex winter".split()
    model = url_filter.Model({w: 50 for w in common})
    found = [model.score(f"www.{n}.net", "/") > 0 for n in (*blocked, *allowed)]
    assert sum(found[: len(blocked)]) >= 0.8 * len(blocked), [n for n, x in zip(blocked, found, strict=False) if not x]
    assert not any(found[len(blocked) :]), [n for n, x in zip(allowed, found[len(blocked) :], strict=True) if x]
