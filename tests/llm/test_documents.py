"""Operators on documents against brute force, and their edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from kinloom.llm import bpe, decontaminate, langid, lines, minhash, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CASE = {c: c + 32 for c in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


def frame(spark, rows, extra=""):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *more) for i, t, *more in rows], SCHEMA + extra)


# ---- near-duplicates ---------------------------------------------------------


def linked(rows, width=4, percent=80):
    """{doc_id: (set size, smallest reachable id)} by comparing all sets that share a shingle."""
    sets = {}
    for doc, text in rows:
        words = SPACED.findall((text or "").translate(CASE))
        k = min(width, len(words))
        sets[doc] = frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, seen = defaultdict(list), []
    for doc, shingles in sorted(sets.items()):
        for other, n in Counter(o for s in shingles for o in holders[s]).items():
            if 100 * n >= percent * (len(shingles) + len(sets[other]) - n):
                a, b = find(doc), find(other)
                parent[max(a, b)] = min(a, b)
        for s in shingles:
            holders[s].append(doc)
        seen.append(doc)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_near_duplicates_equal_brute_force(documents, texts):
    assert as_dict(minhash.near_duplicates(documents)) == linked(texts)


def test_group_of_near_copies_that_only_the_original_joins(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for n in range(60):  # each variant differs from the original by five words of its own place
        words = list(base)
        for j in range(5):
            words[(n * 7 + j * 39) % 200] = f"x{n}y{j}"
        rows.append((n, " ".join(words)))
    rows += [(2000 + n, " ".join(base)) for n in range(20)]
    assert as_dict(minhash.near_duplicates(frame(spark, rows))) == linked(rows)


def test_near_duplicate_edge_cases(spark):
    same = "one two three four five six"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, same), (7, same), (None, same), (7, "other words here now")]
    rows += [(8, "other words here now"), (9, "x " * 50_000)]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    component = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    assert component[(1, 0)] == (1, True) and component[(2, 0)] == (2, True) and component[(3, 0)] == (3, True)
    assert component[(4, 1)] == (4, True) and component[(5, 1)] == (4, False)
    assert component[(7, 3)] == (6, False) and component[(8, 1)] == (6, False)  # 7 carries both texts
    assert component[(None, 3)] == (None, True) and component[(9, 1)] == (9, True)
    assert minhash.near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_long_words_do_not_repeat_themselves(spark):
    """Words beyond the hash's multipliers: swapped halves share no shingle, near copies still meet."""
    a, b = "a" * 4096, "b" * 4096
    long = [f"{'x' * 5000}{i}" for i in range(30)]
    rows = [(1, a + b), (2, b + a), (3, a + b), (4, " ".join(long)), (5, " ".join([*long[:29], "y" * 9000])), (6, f"{b + a} {a + b}")]
    for width in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, rows), width=width).collect()}
        assert got == linked(rows, width)
        assert got[2][1] == 2 and got[3][1] == 1


def test_estimate_follows_similarity(spark):
    a, b = ([f"{p}{i}" for i in range(400)] for p in "ab")
    for share in (0.2, 0.5, 0.8, 1.0):
        n = int(400 * 2 * share / (1 + share))
        x = minhash.minima(minhash.shingle_set(" ".join(a).encode(), 1))
        y = minhash.minima(minhash.shingle_set(" ".join(a[:n] + b[n:]).encode(), 1))
        row = spark.createDataFrame([(minhash.packed(x).tolist(), minhash.packed(y).tolist())], "a array<long>, b array<long>")
        assert abs(row.select(minhash.estimate(row.a, row.b)).first()[0] - share) < 0.2


# ---- lines -----------------------------------------------------------------


def test_line_edge_cases(spark):
    long = "  This line is long enough to be counted as one, surely.  "
    rows = [(i, f"{i}\n{long}\nend") for i in range(6)] + [(None, long), (9, None), (10, ""), (5, "again\n" + long.upper())]
    rows += [(20 + i, "short\n" * 3) for i in range(6)] + [(40, "\n" * 40_000)]
    df = frame(spark, [(*r, "p") for r in rows], ", __line_no string")
    got = lines.line_digests(df).collect()
    assert len(got) == len(rows)
    dropped = {(r.doc_id, r.n_lines): r.n_dropped for r in got}
    assert [dropped[(i, 3)] for i in range(6)] == [1, 1, 1, 1, 1, 0]
    assert dropped[(None, 1)] == 1 and dropped[(9, 1)] == 0 and dropped[(5, 2)] == 0 and dropped[(40, 40_001)] == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.kept_sha256 for r in got if r.doc_id in (None, 9, 10)} == {empty}
    cleaned = lines.dedup_lines(df)
    assert cleaned.columns == df.columns
    assert {r.text for r in cleaned.filter("doc_id = 0").collect()} == {"0\nend"}
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_lines_with_names_of_our_own_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD", 1)
    names = ["row", "runs", "id", "tx", "lost", "lost_id", "shard", "pos", "keeper", "h1", "a.b", "__line_id"]
    rows = [(i, "x" * 50 + "\nown " + str(i) + "\n" + "x" * 50, *["c"] * len(names)) for i in [*range(9), 3, None, -40]]
    df = frame(spark, rows, "".join(f", `{n}` string" for n in names))
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text.count("x" * 50) for r in out.collect()}
    assert got == {i: 2 if i == 8 else 0 for i in [*range(9), None, -40]}
    found = {r.keeper: r.n_docs for r in lines.first_occurrences(lines.long_lines(df, 40)).collect()}
    assert found == {8: 11}
    plan = lines.first_occurrences(lines.long_lines(df, 40))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange range") == 1 and plan.count("Exchange hash") == 1


def test_bitmap_runs_cover_the_kept_lines(spark, documents):
    for r in lines.keep_bitmaps(documents).collect():
        assert sum(run.length for run in r.keep_runs) == r.n_lines - r.n_dropped
        ends = [(run.start, run.start + run.length) for run in r.keep_runs]
        assert all(b < c for (_, b), (c, _) in zip(ends, ends[1:], strict=False))


# ---- benchmark -------------------------------------------------------------


def brute_leaks(text, items, width=10):
    words = WORD.findall((text or "").translate(CASE))
    hit, found = set(), set()
    for item, body in items:
        wanted = WORD.findall((body or "").translate(CASE))
        k = min(width, len(wanted))
        windows = {tuple(wanted[i : i + k]) for i in range(len(wanted) - k + 1)} if wanted else set()
        for i in range(len(words) - k + 1 if windows else 0):
            if tuple(words[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(item)
    return len(words), len(hit), found - {None}


def test_leaks_equal_brute_force_in_one_shard_and_in_many(spark, texts, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    edge = [(None, "tiny item without id"), (777, "Zwölf"), (778, None), (779, "!?"), (777, "twice twice")]
    items += edge
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [*texts[:60], (5000, f"ZWÖLF {items[0][1]} Zwölf--tiny ITEM without id"), (5001, None), (5002, ""), (None, "zwölf")]
    docs = frame(spark, rows)
    for size in (decontaminate.SHARD_CHARS, 500):
        got = decontaminate.contamination(docs, benchmark, shard_chars=size).collect()
        result = Counter((r.doc_id, r.n_words, sum(b - a for a, b in r.ranges), tuple(r.items)) for r in got)
        want = Counter()
        for doc, text in rows:
            n, hit, ids = brute_leaks(text, items)
            want[(doc, n, hit, tuple(sorted(map(str, ids))))] += 1
        assert result == want
    clean = decontaminate.clean_documents(docs, benchmark)
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(d or -1 for d, t in rows if not brute_leaks(t, items)[1])


def test_spans_point_into_the_original():
    automaton = decontaminate.build([("7", "Größe, Maß und Zahl")])
    text = "é– GRößE;maß UND  zahl!"
    n, ranges, items = decontaminate.hits(automaton, text)
    assert (n, ranges, items) == (5, [(1, 5)], {"7"})
    assert [text[x:y] for x, y in decontaminate.spans(text, ranges)] == ["GRößE;maß UND  zahl"]
    assert decontaminate.hits(decontaminate.build([]), "anything")[1] == []


# ---- BPE -------------------------------------------------------------------

ODD = [
    "a" * 3000, "the" * 1500, "$$$###" * 300, "é" * 700, "日本" * 300, "😀" * 50, "a\x1cb \x1f\x1d", "  \n", "",
    "<|endoftext|>a<|startoftext|> b", "don't we'll I'd've", "Σίσυφος ΟΔΥΣΣΕΥΣ İstanbul", "\U00010940 a1b2", "é ﬁ",
]


def test_bpe_equals_the_library(texts):
    coder, library = bpe.encoder(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    for text in ODD + [t for _, t in texts]:
        ids = coder.ids(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(coder, ids) == library.decode(ids, skip_special_tokens=False)


def test_stream_equals_whole_piece_and_decoder_is_incremental():
    coder = bpe.Encoder(bpe.default_path())
    piece = ("theinantionlol" * 200).encode()
    ids = list(coder.stream(iter(piece)))
    assert ids == coder._merged([*map(coder.inner.__getitem__, piece[:-1]), coder.final[piece[-1]]])
    machine = bpe.Decoder(coder)
    assert "".join(machine.feed(ids[i : i + 3]) for i in range(0, len(ids), 3)) == bpe.decode(coder, ids)
    text = bpe.decode(coder, coder.ids("naïve 日本 tea"), raw=False)
    assert text.split() == "naïve 日本 tea".split()


def test_token_digests_of_null_and_empty(spark):
    got = {r.doc_id: r for r in bpe.token_digests(frame(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b")])).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1][1:] == got[2][1:] == (0, empty, empty) and got[3].n_tokens == 2


# ---- classifiers -------------------------------------------------------------


def fold(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def test_language_held_out_accuracy(documents):
    model = langid.fit(documents)
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = [r for r in langid.identify(documents, model).collect() if fold(r.doc_id, 3) == 1]
    assert len(rows) > 50 and sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert (model.weights == 0).mean() > 0.2  # sparse


def test_language_edge_cases(spark, documents):
    model = langid.fit(documents)
    odd = frame(spark, [(1, None), (2, ""), (3, "12 §$ 34"), (None, "the and of the"), (5, "x" * 200_000)])
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[None].lang_pred != "und"
    assert sorted(r.doc_id or 0 for r in langid.accepted(odd, model).collect())[:1] == [0]
    nothing = langid.fit(documents.limit(0))
    assert langid.identify(odd, nothing).filter("lang_pred = 'und'").count() == 5
    assert langid.accepted(odd, nothing).count() == 2


def test_temperature_lowers_the_log_loss():
    import numpy as np

    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 500)
    logits = rng.normal(size=(500, 3))
    logits[np.arange(500), labels] += 1
    t = langid.fit_temperature(logits * 8, labels)
    loss = lambda temp: -np.log(langid._softmax(logits * 8 / temp)[np.arange(500), labels]).mean()
    assert loss(t) < loss(1) and loss(t) <= loss(t * 1.1) and loss(t) <= loss(t / 1.1)


def test_quality_held_out_accuracy(spark, sf_dir):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(documents, quality.fit(documents, labels)).join(labels, "doc_id").collect()
    scored = [r for r in scored if fold(r.doc_id, 5) == 0]
    assert len(scored) > 50 and sum((r.score >= 0.3) == bool(r.quality) for r in scored) >= 0.95 * len(scored)


def test_quality_edge_cases(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    odd = frame(spark, [(1, None), (2, ""), (3, "a"), (None, "b c"), (3, "a"), (4, "x" * 300_000)])
    got = quality.score(odd, quality.fit(documents, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.score(odd, quality.fit(documents, labels.limit(0))).collect()} == {0.5}


# ---- pipeline ----------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark, documents, sf_dir):
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "line_dedup", "near_duplicates", "decontaminate", "bpe"]
    docs, before = documents, {r.doc_id: r.text for r in documents.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "test")
        assert docs.columns == documents.columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "language":
            assert len(after) >= 0.99 * len(before)
        elif name == "near_duplicates":
            groups = linked(before.items(), width=5)
            assert set(after) == {d for d in before if groups[d][1] == d}
        elif name == "decontaminate":
            assert set(after) == {d for d, t in before.items() if not brute_leaks(t, benchmark)[1]}
        before = after
    library = Tokenizer.from_file(bpe.default_path())
    last = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).collect()
    assert {r.doc_id: r.ids for r in last} == {d: library.encode(t, add_special_tokens=False).ids for d, t in before.items()}


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    rows = [(1, None, "x"), (2, "", "x"), (None, "the and of", "y"), (4, "the and of", "y"), (4, "the and of", "y"), (5, "12", None)]
    for given in (rows, []):
        docs = frame(spark, given, ", set_key string")
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "test")
            assert docs.columns[-1] == "set_key"
        assert corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).count() == docs.count()
