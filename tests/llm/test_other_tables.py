"""Top-k, WARC, page text and tool calls against brute force, and their edge cases."""

import base64
import hashlib
import json
import math
import random
import time
from collections import Counter

import duckdb
import numpy as np
import pytest

from kinloom.llm import chat, html_text, queries, topk, warc
from kinloom.session import new_folder

# ---- top-k -----------------------------------------------------------------


def brute_top(rows, k=10, every=100):
    vectors = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    out = {}
    for q, v in vectors.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in vectors.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def as_ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_top_k_in_many_shards_and_blocks(spark, monkeypatch):
    for name, size in (("SHARD_ROWS", 60), ("QUERY_ROWS", 2), ("BLOCK_ROWS", 16)):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 4]) for i in range(400)]  # many ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert as_ranked(topk.top_k(df, every=50)) == brute_top(rows, every=50)


def test_top_k_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (100, [0.0, 0.0]), (3, [0.5]), (4, []), (5, [-1.0, 1.0, 9.0])]
    bad = [(6, None), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (3, [0.5])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS shard")
    assert as_ranked(topk.top_k(df)) == brute_top(rows)
    assert topk.top_k(df.limit(0)).count() == 0


def test_every_vector_of_a_repeated_id_is_found(spark, monkeypatch):
    for name, size in (("SHARD_ROWS", 40), ("QUERY_ROWS", 2), ("BLOCK_ROWS", 16)):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(4)
    rows = {(int(i), tuple(map(float, rng.integers(-9, 10, 4) / 8))) for i in rng.integers(0, 301, 600)}
    # Some queries have several vectors, too; the last two differ below the scale.
    rows = sorted(rows | {(i, (x, 0.5, 1.0, -1.0)) for i in (0, 100, 100_000) for x in (0.25, 2.0)})
    rows += [(77, (9.0001, 9.0, 9.0, 9.0)), (77, (9.0002, 9.0, 9.0, 9.0))]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [(i, list(v)) for i, v in rows])
    df = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df).collect())) == sorted(con.execute(queries.TOP_SQL).fetchall())


def test_max_score_reads_less_than_everything():
    rng = np.random.default_rng(5)
    vectors = np.zeros((4000, 40), np.int64)
    for row in vectors:
        row[rng.integers(0, 40, 4)] = rng.integers(1, 1000, 4)
    shard = topk.Shard(np.arange(4000), vectors)
    ids, scores, read = shard.top(7, vectors[7], 10)
    want = sorted((-(vectors[i] @ vectors[7]), i) for i in range(4000) if i != 7)[:10]
    assert [(-s, i) for s, i in zip(scores, ids, strict=True)] == want
    assert read < 0.9 * 4000 * np.count_nonzero(vectors[7])


# ---- WARC ------------------------------------------------------------------


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 4\r\n\r\nfake\r\n\r\n"


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, least):
    rows = [(1, "u", "same"), (2, "u", "same"), (3, "v", None), (4, None, ""), (5, "a b\r\nX: y", "é日本 long enough")]
    rows += [(6, "w", "é日本 long enough"), (7, "x", FAKE), (8, "y", FAKE + FAKE), (9, "z", "\r\n\r\nWARC/1.0\r\n"), (10, "t", "x" * 500_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' AS record_type")
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    want = set()
    for i, _, h in rows:
        size = len((h or "").encode())
        top = max(groups[h or ""]) if size >= least else i
        want.add((i, size, digest(h), "response" if i == top else "revisit", None if i == top else top))
    assert {tuple(r) for r in warc.round_trip(df, least).collect()} == want


def test_warc_of_repeated_and_nameless_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b")]
    df = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=str)
    assert got == sorted([(0, "response", None), (0, "revisit", 1), (1, "response", None), (1, "response", None)], key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_only_records_on_the_chain_are_reached(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", FAKE * i) for i in range(8)], "page_id long, url string, html string")
    path = new_folder(spark, "warc-test")
    warc.write_archives(df, path)
    assert warc.scan(spark, path).count() > 8
    assert sorted(r.page_id for r in warc.read_archives(spark, path).collect()) == list(range(8))


def test_warc_of_long_urls(spark):
    urls = ["u" * n for n in (65_000, 66_000, 70_000, 1_000_000)] + ["v", "http://x/WARC/1.1", None]
    rows = [(i, url, f"page {i}") for i, url in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert sorted(r.page_id for r in warc.round_trip(df).collect()) == list(range(len(rows)))


@pytest.mark.parametrize("tail", [b"WARC/1.1\r\nContent-Length: 9\r\n\r\ncut", b"\r\n", b"no record"])
def test_a_chain_that_stops_before_the_end_of_its_file_fails(spark, tmp_path, tail):
    record = b"WARC/1.1\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    (tmp_path / "part-0").write_bytes(record * 2)
    assert warc.read_archives(spark, f"file://{tmp_path}").count() == 2
    (tmp_path / "part-1").write_bytes(record + tail)
    with pytest.raises(Exception, match="do not end at its length"):
        warc.read_archives(spark, f"file://{tmp_path}").count()


def test_magics_that_share_a_header_end_are_looked_at_once():
    data = b"WARC/1.1\r\n" * 100_000 + b"Content-Length: 0\r\n\r\n\r\n\r\n"
    assert [c[:2] for c in warc.candidates(data)] == [(0, len(data))]


def test_pointer_jumping_over_a_long_chain():
    offsets = np.arange(0, 50_000, 10)
    inside = offsets[:-1] + 3  # fakes that chain among themselves
    at = np.concatenate((offsets, inside))
    mark = warc.reached(at, at + 10)
    assert mark[: len(offsets)].all() and not mark[len(offsets) :].any()
    assert not warc.reached(np.array([5]), np.array([9])).any()


# ---- page text ---------------------------------------------------------------

PAGES = [
    ("<article><h1>T &amp; t</h1><p><b>a<br><p>b  c</p></article><footer>f</footer>", "T & t a b c"),
    ("<nav>n</nav><p>one <i>tw</i>o&nbsp;x<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "one two x a b c d"),
    ("<header>H</header><main><header><h1>K</h1></header>text<aside>s</aside></main>", "K text"),
    ('<div class="cookie-notice">c</div><div id="sideBar">s</div><p>kept</p><div role="search">q</div>', "kept"),
    ("<p>a<script>if (1<2) '</p>'</script>b<style>p{}</style><!-- x <p> -->c<form>f</form></p>", "abc"),
    ('<article>yes</article><section class="comments"><article class="comment">no</article></section>', "yes"),
    ('<p title="a>b" hidden>gone</p><p>stays</p>', "stays"),
    ("<p>unclosed <b>bold <div>&lt;x&gt; &#233; &unknown;", "unclosed bold <x> é &unknown;"),
    ("plain text", "plain text"),
    ("", ""),
    (None, ""),
    ("<scr", ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page, set()) == text


LONG = "The story goes on and on."
WRAPPED = [
    (f'<div class="content no-sidebar"><p>{LONG}</p></div>', LONG),
    (f'<div class="site hasSidebar page--menu with_comments"><p>{LONG}</p></div><div class="sidebar">s</div>', LONG),
    (f'<article class="post has-comments category-social">{LONG}</article>', LONG),
    (f'<article><div class="post-header"><h1>T</h1></div><p>{LONG}</p><div class="comments">c</div></article>', f"T {LONG}"),
    (f'<div class="entry"><div class="entry-header"><h1>T</h1></div><p>{LONG}</p></div>', f"T {LONG}"),
    (f'<form id="aspnetForm"><label>Find</label><input><div class="menu">m</div><p>{LONG}</p><button>Go</button></form>', LONG),
    (f'<form role="form"><main><p>{LONG}</p></main><select><option>o</select></form>', LONG),
    (f'<div class="layout left-sidebar"><article>{LONG}</article><div id="sidebar">s</div></div>', LONG),
    (f'<main><div class="layout left-sidebar"><p>{LONG}</p><ul class="menu"><li>m</ul></div></main>', LONG),
    (f'<p>lead</p><div class="layout left-sidebar"><p>{LONG}</p></div>', f"lead {LONG}"),
    ('<article class="social">short</article><p>longer than the article</p>', "short"),
    (f'<article>short</article><section class="comments"><article>{LONG}</article></section>', "short"),
    (f'<p>short</p><div class="menu"><a href="/">{LONG}</a></div><form>f</form>', "short"),
    ('<div class="menu"><a href="/">only</a></div><nav>n</nav>', "only"),
    (f"<article> </article><p>{LONG}</p>", LONG),
    ('<div class="ad">' * 3000 + "<article>deep", "deep"),
]


@pytest.mark.parametrize(("page", "text"), WRAPPED)
def test_wrappers_named_after_furniture_keep_their_article(page, text):
    assert html_text.main_text(page, set()) == text


def test_templates_are_found_per_host(spark):
    menu = "<div><p>Our site</p><p>since ever</p></div>"
    rows = [(i, f"http://A.org:80/{i}", f"{menu}<p>story {i}</p><p>end</p>") for i in range(8)]
    rows += [(10 + i, "http://copies.org/x", "<p>all the same</p>") for i in range(9)]
    rows += [(30 + i, f"https://u@b.org/{i}", f"<p>own {i}</p>" + ("<p>rare</p>" if i < 2 else "")) for i in range(8)]
    rows += [(50, None, menu), (None, "no host", None), (10, "http://copies.org/x", "<p>all the same</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' AS host", "1 AS template")
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect()]
    text = dict((i, t) for i, t, _ in got)
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert [text[i] for i in range(8)] == [f"story {i}" for i in range(8)]
    assert text[12] == "all the same" and text[30] == "own 0 rare" and text[50] == "Our site since ever" and text[None] == ""
    assert html_text.extract(df.limit(0)).count() == 0


# ---- tool calls --------------------------------------------------------------


def message(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments", "needs"), c, strict=False)) for c in calls]})


def answer(call, content="r"):
    return json.dumps({"tool_call_id": call, "content": content})


def test_linking_cases(spark):
    good = '{"limit": 3.0, "query": "é"}'
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", message(("a", "search", good), ("b", "count_words", '{"text":"x"}', ["a"]), ("z", "count_words", "{", ["b", "later"]))),
        (1, 2, "tool", answer("b")),
        (1, 3, "tool", answer("a", "first")),
        (1, 4, "tool", answer("a", "second")),
        (1, 5, "assistant", message(("later", "search", '{"query":"","limit":99,"x":1}', ["a", "b"]), ("a", "nonsense", "{}"))),
        (1, 6, "tool", answer("ghost")),
        (2, 0, "tool", answer("c")),
        (2, 1, "assistant", message(("c", "translate", '{"text":"t","to":"it"}', ["c"]))),
        (2, 2, "assistant", "just text"),
        (2, 3, "assistant", None),
        (None, 1, "assistant", message(("n", "search", good))),
    ]
    df = spark.createDataFrame(rows + rows[:3], "conv_id long, turn long, role string, text string").selectExpr("*", "'q' AS status")
    got = {(r.conv_id, r.call_id): r for r in chat.link(df, chat.SCHEMAS).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (1, "z"), (1, "later"), (1, "ghost"), (2, "c")}
    assert {k: (r.status, r.level, r.result_turn, r.valid) for k, r in got.items()} == {
        (1, "a"): ("linked", 0, 3, True),
        (1, "b"): ("linked", 1, 2, True),
        (1, "z"): ("unanswered", 2, None, False),
        (1, "later"): ("unanswered", 2, None, False),
        (1, "ghost"): ("orphan", None, 6, None),
        (2, "c"): ("early", 0, 0, False),
    }
    assert got[(1, "a")].json == '{"arguments":{"limit":3,"query":"é"},"id":"a","name":"search","needs":[],"result":"first","status":"linked"}'
    assert got[(1, "later")].errors == ["$: unknown x", "$.limit: too large", "$.query: length"]
    assert got[(1, "z")].errors == ["arguments are not JSON", "1 needs are unknown or later"]
    assert got[(2, "c")].errors == ["$.to: not in enum", "1 needs are unknown or later"]
    assert chat.link(df.limit(0), chat.SCHEMAS).count() == 0


def test_long_chain_takes_few_rounds(spark):
    n = 700
    rows = [(1, 2 * i, "assistant", message((f"c{i}", "count_words", '{"text":"x"}', [f"c{i - 1}"] if i else []))) for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {(r.call_id, r.level) for r in chat.link(df, chat.SCHEMAS).collect()} == {(f"c{i}", i) for i in range(n)}


def test_derived_conversations_link_as_counted(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = {(r.conv_id, r.turn): r.role for r in table.collect()}
    got = chat.link(chat.with_tool_calls(table), chat.SCHEMAS).collect()
    calls = {k for k, role in turns.items() if role == "assistant"}
    answers = {(c, t - 1) for (c, t), role in turns.items() if role == "user"}
    assert len(got) == len(calls | answers)
    assert sum(r.status == "linked" for r in got) == len(calls & answers)
    assert sum(r.status == "orphan" for r in got) == len(answers - calls)
    assert all(r.status == "orphan" or json.loads(r.json)["id"] == r.call_id for r in got)


# ---- whatever valid JSON may hold ---------------------------------------------


def calling(conv, turn, calls):
    return (conv, turn, "assistant", json.dumps({"tool_calls": calls}))


def test_numbers_of_any_size_and_lone_surrogates(spark):
    arguments = ['{"query":"x","limit":' + "9" * 400 + "}", '{"query":"\\ud800","limit":1}', '{"query":"x","limit":1,"\\udfff":2}', '{"limit":1e999}']
    rows = [calling(1, i, [{"id": f"c{i}", "name": "search", "arguments": a, "needs": []}]) for i, a in enumerate(arguments)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.call_id: r for r in chat.link(frame, chat.SCHEMAS).collect()}
    assert got["c0"].errors == ["$.limit: too large"] and got["c1"].errors == []
    assert json.loads(got["c1"].json)["arguments"]["query"] == "\ud800"
    assert got["c2"].errors == ["$: unknown \\udfff"] and got["c3"].errors == ["arguments are not JSON"]


@pytest.mark.parametrize("schema", [{"pattern": "a"}, {"items": {"$ref": "#"}}, {"properties": {"a": {"anyOf": []}}}, {"type": "float"}, True])
def test_schemas_that_say_more_are_refused(spark, schema):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    with pytest.raises(ValueError, match="schema"):
        chat.link(empty, {"tool": schema})


def test_keywords():
    wrong = lambda value, **schema: bool(chat.violations(value, schema))
    assert wrong(1, enum=[True]) and not wrong(1.0, enum=[1]) and wrong(2, const=1) and not wrong([1], const=[1])
    assert wrong(3, exclusiveMinimum=3) and wrong(3, exclusiveMaximum=3) and wrong([1], minItems=2) and wrong([1, 2], maxItems=1)


def test_links_equal_brute_force(spark):
    """Random conversations: several needs a call, unknown and later needs, repeated ids, early and missing results."""
    draw = random.Random(4)
    rows, calls, results = [], {}, {}
    for conv in range(40):
        for turn in range(draw.randrange(12)):
            if draw.random() < 0.5:
                made = [
                    {"id": f"c{draw.randrange(12)}", "name": draw.choice(["search", "translate", "none"]), "arguments": draw.choice(['{"query":"q","limit":5}', "{", "{}"]),
                     "needs": [f"c{n}" for n in draw.sample(range(13), draw.randrange(4))]}
                    for _ in range(draw.randrange(3))
                ]
                rows.append(calling(conv, turn, made))
                for place, call in enumerate(made):
                    calls.setdefault((conv, call["id"]), (turn, place, call))
            else:
                name, content = f"c{draw.randrange(12)}", draw.choice(["r", "s"])
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": name, "content": content})))
                results.setdefault((conv, name), []).append((turn, content))
    levels, bad = {}, {}
    for key, (turn, place, call) in sorted(calls.items(), key=lambda x: x[1][:2]):
        sound = [n for n in set(call["needs"]) if (key[0], n) in calls and calls[key[0], n][:2] < (turn, place)]
        bad[key] = len(set(call["needs"])) - len(sound)
        levels[key] = max((levels[key[0], n] + 1 for n in sound), default=0)
    expected = {}
    for key in calls.keys() | results.keys():
        found = sorted(results.get(key, []))
        if key not in calls:
            expected[key] = (None, None, "orphan", found[0][0], None)
            continue
        turn, _, call = calls[key]
        behind = [r for r in found if r[0] > turn]
        status = "linked" if behind else "early" if found else "unanswered"
        _, errors = chat.checked(call["name"], call["arguments"], chat.SCHEMAS)
        errors = [*errors, *([f"{bad[key]} needs are unknown or later"] if bad[key] else [])]
        expected[key] = (turn, levels[key], status, (behind or found or [(None,)])[0][0], errors)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.call_id): (r.turn, r.level, r.status, r.result_turn, None if r.status == "orphan" else r.errors) for r in chat.link(frame, chat.SCHEMAS).collect()}
    assert got == expected


# ---- long and deep pages ------------------------------------------------------


@pytest.mark.parametrize("page", ["<div>" * 16_000 + "</i>" * 16_000, "<p><b>" * 30_000, "<li><ul>" * 30_000, '<div class="x">' * 70_000])
def test_deep_pages_take_linear_time(page):
    start = time.process_time()
    assert html_text.main_text(page + "the text", set()) == "the text"
    assert time.process_time() - start < 15


def test_templates_equal_brute_force(spark):
    """Every subtree that recurs on enough pages of its host goes, on random pages of three hosts."""
    draw = random.Random(9)
    pages = []
    for i in range(60):
        blocks = [f"<p>{draw.choice(['alpha', 'beta', 'gamma', 'delta'])} block</p>" for _ in range(draw.randrange(4))]
        pages.append((i, f"http://h{i % 3}.org/{i}", f"<body><div>{''.join(blocks)}</div><p>page {i}</p></body>"))
    seen = {}
    for i, url, _ in pages:
        seen.setdefault(url.split("/")[2], []).append(i)
    trees = {i: html_text.scope(html_text.parse(page)) for i, _, page in pages}
    hashes = {i: set(html_text.subtree_hashes(t).values()) for i, t in trees.items()}
    got = {r.host: set(r.template) for r in html_text.templates(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for host, ids in seen.items():
        counts = Counter(h for i in ids for h in hashes[i])
        least = max(html_text.MIN_PAGES, html_text.MIN_SHARE * len(ids))
        assert got.get(host, set()) == {h for h, n in counts.items() if n >= least}
