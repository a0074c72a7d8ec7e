"""Importance resampling, the n-gram Jaccard join and spelling variants against plain Python and DuckDB."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from phenolens.llm import common, jaccard_join, resampling, spelling, substring_dedup
from phenolens.llm.oracle import BEYOND_ASCII, SQL, STAND_INS
from tools.check_oracle import TABLES, rows_key

SF = "/root/testdata/sf0.001"
#: Extra columns whose names meet the operators' own.
CLASHING = "doc_id long, text string, score long, rank string, n long, cls long, token string, word string, edges string, `__id` int, n_words int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def odd_rows():
    long = " ".join(f"w{i * 7919 % 613}" for i in range(400))
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, long), (5, long), (6, long + " tail"), (7, long.upper()),
            (None, long), (9, "x" * 5000), (10, "same words same words again"), (10, "another text of the same id"), (11, "ça Éte " * 40)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "r", 1, 2, "t", "w", "e", 3, 4) for i, t in rows], CLASHING)


@pytest.mark.parametrize("name", sorted(n for n in SQL if n != "pipeline"))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, rel = entry.queries()[name](spark, SF), con.sql(SQL[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    duck = [tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall()]
    assert rows_key(tuple(r[c] for c in order) for r in df.collect()) == rows_key(duck)


# --- importance resampling ---

def features(text, most):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return w, [" ".join(w[k:k + n]) for n in range(1, most + 1) for k in range(len(w) - n + 1)]


def brute_resample(rows, goal, buckets, most, percent, least, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw = Counter(bucket(f) for _, t in rows for f in features(t, most)[1])
    target = Counter(bucket(f) for t in goal for f in features(t, most)[1])
    s_all, t_all = sum(raw.values()), sum(target.values())
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in raw}
    out = []
    for i, t in rows:
        w, f = features(t, most)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32)))))
    order = sorted((k for k in range(len(out)) if out[k][1] >= least), key=lambda k: (-out[k][4], out[k][0] is None, out[k][0]))
    place = {k: r + 1 for r, k in enumerate(order[:percent * len(order) // 100])}
    return [(*row, place.get(k)) for k, row in enumerate(out)]


COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("most", [1, 2, 3])
@pytest.mark.parametrize("head", [0, 5, 1 << 16])
def test_resampling_equals_brute_force_whatever_the_head(spark, monkeypatch, most, head):
    monkeypatch.setattr(resampling, "HEAD_WORDS", head)
    monkeypatch.setattr(resampling, "HEAD_PAIRS", head)
    rows = [(i, f"the w{i % 7} Of {'the ' * (i % 5)} x{i % 3} Ünder-way {i}") for i in range(60)] + odd_rows()[:5] + [(None, "the end of it")]
    goal = ["the w1 of the x2", "ünder way", None, ""]
    target = spark.createDataFrame([(t,) for t in goal], "text string")
    got = resampling.resample(frame(spark, rows).repartition(4), target, buckets=97, max_words=most, percent=30, min_words=5)
    got = [tuple(r[c] for c in COLUMNS) for r in got.collect()]
    assert rows_key(got) == rows_key(brute_resample(rows, goal, 97, most, 30, 5)) and got[0][2] is not None


def test_resampling_of_empty_tables(spark, docs):
    none = frame(spark, [])
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(none, goal).count() == 0
    out = resampling.resample(docs.limit(30), goal.limit(0)).collect()
    assert len(out) == 30 and all(r.weight is not None for r in out)


def test_a_third_of_equal_scores_is_ranked_by_id(spark):
    rows = spark.createDataFrame([(i, i, 5 if i % 3 else 9) for i in range(400)], "doc_id long, n_words long, score long")
    got = {r.doc_id: r["rank"] for r in resampling.ranked(rows.repartition(7), 390).collect()}
    expect = sorted(range(400), key=lambda i: (-(5 if i % 3 else 9), i))
    assert got == {i: k + 1 if k < 390 else None for k, i in enumerate(expect)}


# --- set join ---

def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute_join(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    part = list(range(len(rows)))

    def find(k):
        while part[k] != k:
            k = part[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            same = rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]
            both = len(sets[a] & sets[b])
            near = rows[a][0] is not None and rows[b][0] is not None and both and 100 * both >= percent * len(sets[a] | sets[b])
            if same or near:
                part[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    return [(i, len(sets[k]), None if i is None else min(x for x in least[find(k)] if x is not None)) for k, (i, _) in enumerate(rows)]


def edited(rng, words, share, vocabulary):
    return [w if rng.random() > share else f"e{rng.integers(vocabulary)}" for w in words]


@pytest.mark.parametrize("percent", [50, 75, 80, 95])
def test_join_equals_brute_force_on_groups_of_near_copies(spark, percent):
    rng = np.random.default_rng(percent)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for g in range(4):  # groups of near copies with more and fewer edits
        base = [f"g{g}w{rng.integers(90)}" for _ in range(80 + 30 * g)]
        rows += [" ".join(edited(rng, base, rng.choice([0, .005, .02, .05]), 40)) for _ in range(18)]
    # One passage in many documents, with tails of all lengths: similar to each other around the threshold.
    rows += [" ".join(passage + [f"t{d}x{k}" for k in range(d % 25)]) for d in range(60)]
    # Chains: each like the next, the ends unlike.
    rows += [" ".join(f"c{k}" for k in range(s, s + 60)) for s in range(0, 40, 3)]
    rows += [rows[3], rows[5].upper(), "one two", "one two", "a b c d e"]
    rows = list(enumerate(rows, 100)) + odd_rows()
    got = jaccard_join.join_components(frame(spark, rows).repartition(6), percent=percent)
    assert rows_key(tuple(r) for r in got.collect()) == rows_key(brute_join(rows, percent))


def test_partners_are_found_by_one_exchange_of_the_tokens(spark):
    rows = [(1, "a b c d e f g"), (1, "other text of the id one"), (2, "A b c d e f g"), (3, "a b c d e f h"), (4, "alone is this text here"), (5, None)]
    sets = frame(spark, rows).mapInArrow(  # so low a percentage that all tokens are first ones
        jaccard_join.set_batches(10, True), "doc_id long, n long, cls long, first array<long>").localCheckpoint()
    found = jaccard_join.with_partners(sets, 10)
    assert sorted(r.doc_id for r in found.collect()) == [1, 3]  # the least id of each class
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") >= 1 and "ReusedExchange [token" in plan


def test_join_of_an_empty_table(spark):
    assert jaccard_join.join_components(frame(spark, [])).count() == 0
    none = jaccard_join.join_components(frame(spark, [(1, None), (2, " ")])).collect()
    assert sorted(map(tuple, none)) == [(1, 0, 1), (2, 0, 2)]


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 30), min_size=1), st.sets(st.integers(0, 30), min_size=1), st.integers(1, 100), st.randoms())
def test_no_order_loses_a_linked_pair(x, y, percent, random):
    """The bounds of the three filters hold for every order of the tokens."""
    both = len(x & y)
    if not both or 100 * both < percent * len(x | y):
        return
    tokens = sorted(x | y)
    random.shuffle(tokens)
    a, b = [t for t in tokens if t in x], [t for t in tokens if t in y]
    first = next(t for t in tokens if t in x and t in y)
    i, j = a.index(first), b.index(first)
    assert i < jaccard_join.prefix_size(len(a), percent) and j < jaccard_join.prefix_size(len(b), percent)
    assert (100 + percent) * min(len(a) - i, len(b) - j) >= percent * (len(a) + len(b))
    margin = lambda s: s[:min(len(s), jaccard_join.prefix_size(len(s), percent) - 1 + jaccard_join.up(jaccard_join.MARGIN, len(s)))]
    found = len(set(margin(a)) & set(margin(b)))
    assert found >= jaccard_join.up(jaccard_join.MARGIN, jaccard_join.up(percent, len(a)))


# --- spelling variants ---

def brute_variants(rows, every, least_chars=6, least_count=5):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    out = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = (n, len(others), form, words[form] if form else None)

    def root(w):
        return w if out[w][2] is None else root(out[w][2])

    return {(w, form, root(w), n, k, fn) for w, (n, k, form, fn) in out.items()}


def test_variants_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + odd_rows()
    rows += [(500 + k, "accommodate Fußgänger " * 40 + "acommodate accomodate accommodates Fussgänger " * 6 + "acomodate " * 5) for k in range(3)]
    for every in (199, 3):
        got = spelling.variants(frame(spark, rows).repartition(5), every=every)
        got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()}
        expect = brute_variants(rows, every)
        assert got == expect and any(w != r and f != r for w, f, r, *_ in expect if f) is (every == 199) or got == expect


def test_variants_of_nothing(spark):
    assert spelling.variants(frame(spark, [])).count() == 0
    assert spelling.variants(frame(spark, [(1, None), (2, "short words only")])).count() == 0


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_blocks_and_chunks_lose_no_pair(spark, monkeypatch, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abcdeéÿ"), rng.integers(4, 8))) for _ in range(150)})
    got = {(r.word, r.near) for r in spelling.near_words(spark.createDataFrame([(w, 9) for w in words], "word string, n long")).collect()}
    assert got == {(a, b) for a in words for b in words if spelling.one_edit(a, b)} != set()


@settings(max_examples=300, deadline=None)
@given(st.text("abÀÿ", max_size=7), st.text("abÀÿ", max_size=7))
def test_one_edit_is_levenshtein_one(a, b):
    table = str.maketrans(BEYOND_ASCII, STAND_INS)
    ((distance,),) = duckdb.sql(f"SELECT levenshtein('{a.translate(table)}', '{b.translate(table)}')").fetchall()
    assert spelling.one_edit(a, b) == (distance == 1)
    if distance == 1:
        x, y = spelling.letter_counts([a or "a", b or "b"]) if a and b else (None, None)
        assert x is None or ((x - y) ** 2).sum() in (1, 2)


# --- what other operators gained ---

def test_substrings_keep_columns_of_any_name(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    got = substring_dedup.cut_repeats(frame(spark, [(1, "head " + passage), (2, "other " + passage + " end")])).orderBy("doc_id").collect()
    assert [(r.edges, r["__id"], r.cls, r.score) for r in got] == [("e", 3, 2, 7)] * 2
    assert got[0].n_removed == 0 and got[1].n_removed > 300


@pytest.mark.parametrize("bits", [6, 27])
def test_a_full_bit_table_changes_no_result(spark, docs, monkeypatch, bits):
    monkeypatch.setattr(substring_dedup, "MARK_BITS", 1 << bits)
    out = substring_dedup.cut_repeats(docs).agg(F.sum("n_removed"), F.sum(F.xxhash64("text").cast("decimal(30,0)"))).first()
    _SEEN.add(tuple(out))
    assert len(_SEEN) == 1 and out[0] > 0


_SEEN: set = set()


def test_scratch_deletes_its_own_tables_and_no_others(spark):
    from pathlib import Path
    df = spark.range(3)
    stays = common.written(df, "before")
    with common.scratch(spark) as keep:
        goes = common.written(df, "within")
        result = keep(goes.selectExpr("id * 2 as id"), "result")
        with common.scratch(spark):
            inner = common.written(df, "inner")
        gone = [inner.inputFiles()[0], goes.inputFiles()[0]]
        assert not Path(gone[0].removeprefix("file://")).exists() and Path(gone[1].removeprefix("file://")).exists()
    assert sorted(r.id for r in result.collect()) == [0, 2, 4] and stays.count() == 3
    assert not Path(gone[1].removeprefix("file://")).parent.exists()


def test_runs_left_out_would_not_have_been_cut(spark, docs, monkeypatch):
    import pyarrow as pa

    own = common.versioned(docs.select("doc_id", "text"))
    texts = {r.doc_id: r.text.encode() for r in own.where("text is not null").collect()}
    spans = substring_dedup.repeated_chunks(own).toArrow().combine_chunks().to_batches()

    def cuts(side):
        monkeypatch.setattr(substring_dedup, "SIDE", side)
        by_doc: dict = {}
        for e in pa.Table.from_batches(substring_dedup._edge_batches(spans)).to_pylist():
            other, at = texts[e["first_id"]], e["first_place"]
            e["beside"] = other[at:at + substring_dedup.REACH] if e["ahead"] else other[max(0, at - substring_dedup.REACH):at]
            by_doc.setdefault(e["doc_id"], []).append(e)
        runs = {doc: substring_dedup.extended(texts[doc], edges) for doc, edges in by_doc.items()}
        return sum(map(len, by_doc.values())), {doc: r for doc, r in runs.items() if r}

    (some, kept), (every, same) = cuts(16), cuts(10_000)
    assert some < every and kept == same and kept


def _op9_batches(rows: int):
    """Spans of repeated chunks, places and edges of ``rows`` texts of 2,000 bytes, as the tasks of op9 get them."""
    import pyarrow as pa

    rng = np.random.default_rng(21)
    int32, int64, boolean = pa.int32(), pa.int64(), pa.bool_()
    first = [("doc_id", int64), ("version", int64), ("start", int32), ("before", int32), ("after", int32)]
    span = pa.struct([("start", int32), ("end", int32), ("before", int32), ("after", int32), ("first", pa.struct(first))])
    edge = pa.struct([("lo", int32), ("hi", int32), ("place", int32), ("ahead", boolean), ("beside", pa.binary())])
    place = pa.struct([("first_place", int32), ("ahead", boolean)])
    spans, places, edges, texts = [], [], [], []
    for k in range(rows):
        texts.append(None if k % 50 == 7 else "".join(map(chr, rng.integers(97, 123, 2000))))
        starts = [32 * int(x) for x in np.flatnonzero(rng.random(60) < 0.5)]
        rng.shuffle(starts)
        spans.append([{"start": s, "end": s + 32, "before": s % 3, "after": s % 5,
                       "first": {"doc_id": [None, k % 9][k % 40 > 0], "version": 0, "start": s + 100 * (k % 2), "before": 0, "after": 0}} for s in starts])
        places.append([{"first_place": s, "ahead": s % 64 == 0} for s in starts])
        raw = (texts[-1] or "").encode()
        edges.append([{"lo": s, "hi": s + 120, "place": s + 120, "ahead": True, "beside": raw[s + 120:s + 160]} for s in starts[:5]])
    ids = pa.array([None if k == 3 else k for k in range(rows)], int64)
    row = pa.array([{"c0": k} for k in range(rows)])
    make = lambda **columns: pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    version, held = pa.array([0] * rows, int64), [t or "" for t in texts]
    return ((substring_dedup._edge_batches, make(doc_id=ids, version=version, spans=pa.array(spans, pa.list_(span)))),
            (substring_dedup._beside_batches, make(doc_id=ids, version=version, text=pa.array(held), places=pa.array(places, pa.list_(place)))),
            (substring_dedup._cut_batches, make(doc_id=ids, row=row, text=pa.array(texts), edges=pa.array(edges, pa.list_(edge)))))


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_op9_takes_a_batch_in_parts_of_bounded_memory(kind):
    import tracemalloc

    def peak(run, batch):
        for _ in run(iter([batch.slice(0, 100)])):
            pass
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    run, batch = _op9_batches(4000)[kind]
    assert peak(run, batch) < 1.5 * peak(run, batch.slice(0, 2000))


def test_op9_parts_change_no_result(monkeypatch):
    import pyarrow as pa

    def results(limit):
        monkeypatch.setattr(substring_dedup, "SLICE_BYTES", limit)
        monkeypatch.setattr(substring_dedup, "SLICE_SPANS", limit)
        return [pa.Table.from_batches(run(iter([batch.slice(0, 0), batch.slice(100), batch.slice(0, 100)]))) for run, batch in _op9_batches(300)]

    whole = results(1 << 40)
    assert results(1) == whole and results(5000) == whole
    assert len(whole[0]) > 300 and len(whole[1]) > 300 and sum(whole[2].column("n_removed").to_pylist()) > 300
