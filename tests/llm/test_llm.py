"""The training-text operators against brute force, exact round trips and planted cases."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from phenolens.llm import (
    bpe,
    common,
    fingerprint,
    language_id,
    licenses,
    near_dedup,
    packing,
    pii,
    quality,
    substring_dedup,
    suffix_dedup,
)
from phenolens.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = ("and the thing that we all saw was the long road over the hill where no one had been before "
           "the rain came down and washed the stones so that each of them shone like a small lamp in the "
           "dark and we went on for as long as there was light enough to see the way ahead of us there")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in rows], SCHEMA)


def odd_rows():
    words = [f"w{i * 7919 % 613}" for i in range(400)]
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, " ".join(words)), (6, " ".join(words[:-2] + ["new"])),
            (7, " ".join(words).upper()), (7, " ".join(words).upper()), (None, "null id here"), (9, "x" * 3000),
            (10, "ab " * 700), (11, PASSAGE + " tail one"), (12, "head two " + PASSAGE), (12, "other version of twelve")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows())


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_registered_queries_have_the_numbers_one_to_thirteen():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES}
    assert numbers == set(range(1, 14)) and set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


# --- near duplicates ---

def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in sorted(sets.items()):
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in s:
            holders[x].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_duplicates_match_brute_force(docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_odd_rows(odd, empty):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_shingles == 0 and by_id[1].kept and by_id[4].n_shingles == 1
    assert by_id[6].component_id == 5 and by_id[7].component_id == 5 and not by_id[7].kept
    assert by_id[None].component_id is None and by_id[None].kept
    assert near_dedup.near_duplicates(empty).count() == 0


def test_sketch_estimates_jaccard():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 62, 900).astype(np.uint64)
    a = np.sort(np.concatenate((common, rng.integers(0, 1 << 62, 100).astype(np.uint64))))
    b = np.sort(np.concatenate((common, rng.integers(0, 1 << 62, 100).astype(np.uint64))))
    s = near_dedup.sketches(np.repeat([0, 1], 1000), np.concatenate((a, b)), 2)
    assert (s != np.uint64(2 ** 64 - 1)).all() and abs((s[0] == s[1]).mean() - 900 / 1100) < 0.12
    one = near_dedup.sketches(np.zeros(1, int), a[:1], 1)
    assert (one != np.uint64(2 ** 64 - 1)).all()


# --- quality ---

def test_quality_base_matches_brute_force(docs, texts, odd, empty):
    rows = quality.base(quality.read(docs)).collect()
    for r in rows:
        t = texts[r.doc_id]
        w = words_of(t)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if words_of(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    model = quality.Model((0.0,) * quality.BUCKETS, -float("inf"))
    got = {r.doc_id: r for r in quality.with_verdict(odd, model).collect()}
    assert not got[1].kept and got[10].base_failed and got[5].kept
    assert quality.with_verdict(empty, model).count() == 0


def test_quality_verdict_can_be_filtered(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdict = quality.with_verdict(docs.withColumn("__words", F.lit(1)), quality.fit(docs, labels))
    every = {r.doc_id: r for r in verdict.collect()}
    kept = verdict.where("kept and not base_failed")
    assert {r.doc_id for r in kept.collect()} == {i for i, r in every.items() if r.kept}
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter (") < plan.index("Generate")  # the filter reads finished columns
    assert plan.count("Generate inline") == 3  # words, hashes and windows once a row each


def test_quality_separates_the_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.with_verdict(docs, quality.fit(docs, labels)).where("not base_failed").join(labels, "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1) and not any(r.kept for r in rows if r.quality == 0)
    none = labels.where("false")
    assert quality.fit(docs, none).threshold == -float("inf")


def test_quality_counts_every_labelled_document(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 300, 12))) for i in range(10_300)]
    docs, labels = frame(spark, rows), spark.range(len(rows)).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert set(quality.fit(docs, labels).weights) == {0.0}  # all are good, so the target is the corpus
    good, bad = " ".join(f"good{i}" for i in range(60)), " ".join(f"bad{i}" for i in range(60))
    docs = frame(spark, [(i, f"{good if i % 3 else bad} x{i % 4}") for i in range(60)])
    labels = spark.range(10, 90).select(F.col("id").alias("doc_id"), (F.col("id") % 3 != 0).cast("int").alias("quality"))
    model = quality.fit(docs, labels.union(labels))
    rows = quality.with_verdict(docs, model).collect()
    assert all(r.kept == bool(r.doc_id % 3) for r in rows)
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 0)
    assert quality.fit(docs, labels) == model


def best_cut(scored):
    good, bad = [s for s, q in scored if q == 1], [s for s, q in scored if q == 0]
    every, best, cut = sorted({*good, *bad}), 0, -float("inf")
    for k, s in enumerate(every if good and bad else []):
        gain = sum(x <= s for x in bad) * len(good) - 5 * sum(x <= s for x in good) * len(bad)
        if gain > best:
            best, cut = gain, (s + (every[k + 1] if k + 1 < len(every) else s + 1)) / 2
    return cut


def test_threshold_is_the_best_cut_of_all_scores(spark):
    rng = np.random.default_rng(6)
    for n, digits, apart in ((0, 3, 0), (40, 1, 1), (400, 4, 0.02), (400, 2, 3), (300, 3, -1)):
        quality_of = rng.integers(0, 2, n)
        scores = np.round(rng.normal(0, 1, n) + apart * quality_of, digits)
        scored = [(float(s), int(q)) for s, q in zip(scores, quality_of, strict=True)]
        for rows in (scored, [r for r in scored if r[1]], scored + [(9.5, 2)]):
            got = quality.threshold_of(spark.createDataFrame(rows, "s double, quality int"))
            assert got == best_cut(rows)


# --- personal data ---

def brute_pii(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


@pytest.mark.parametrize("text", [
    "a@b.c", "x@@y.z w@v", "a.b@c.d@e.f g", "@a.b", "1.2.3.4.5.6.7.8 300.1.1.1", "0001.2.3.004", "4111 1111-1111 1111 9",
    "+1 (743) 555-3824. +12", "++44 20 7946 0958", "é@b.de ü+49 30 123456", "a@b-.c-.d. x", ""])
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute_pii(text)


def test_best_tags_are_those_of_the_whole_text():
    rng = np.random.default_rng(3)
    for k in range(400):
        offs = np.concatenate(([0], np.cumsum(rng.integers(0, 12, rng.integers(1, 6)))))
        scores = rng.normal(0, 2, (offs[-1], pii.TAGS))
        scores[:, 0] += k % 4
        step = rng.normal(0, 2, (pii.TAGS, pii.TAGS)) + np.eye(pii.TAGS) * (k % 3)
        if not offs[-1]:
            continue
        got = pii.best_tags(scores, offs, step)
        for lo, hi in zip(offs[:-1], offs[1:], strict=True):
            assert lo == hi or (pii.viterbi(scores[None, lo:hi], step)[0] == got[lo:hi]).all()


def test_model_adds_rewritten_forms_and_leaves_prose_alone(spark):
    rng = np.random.default_rng(5)
    prose = "thing of the inner hand and ered onto then".split()

    def filler(n):
        return " ".join(rng.choice(prose, n))

    rows = []
    for i in range(400):
        data = (f"hein.{i}@mail{i % 9}.example.com", f"{i % 250}.{i * 7 % 250}.{i * 3 % 250}.9",
                f"+1 ({200 + i}) 555-{1000 + i}", f"token = \"{hashlib.md5(str(i).encode()).hexdigest()}\"")[i % 4]
        rows.append((i, f"{filler(12)} {data} {filler(12)}"))
    docs = frame(spark, rows)
    model = pii.fit(docs)
    found = pii.find(docs, model).collect()
    assert sum(r.n_added for r in found) <= 4
    new = ["the inner (543) 555-1234 thing of then", "of ered hein.19(at)mail5.example.com onto the hand"]
    assert [[s[0] for s in spans] for spans in pii.model_spans(model, new)] == [["phone"], ["email"]]
    text = pii.redact(docs, model).where("doc_id = 0").first().text
    assert "<email>" in text and "@" not in text


def test_model_finds_rewritten_emails_without_digits(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvwz"), int(rng.integers(4, 8))))
    prose = "the thing of an inner hand was seen at home and then we met at noon".split()

    def filler(n):
        return " ".join(rng.choice(prose, n))

    docs = frame(spark, [(i, f"{filler(14)} {word()}.{word()}@{word()}.com {filler(14)}") for i in range(500)]
                 + [(i, filler(40)) for i in range(500, 700)])
    model = pii.fit(docs)
    new = [f"{filler(30)} {data} {filler(30)}" for data in ("maria.klein(at)example.com", "maria.klein at example dot com")]
    for text, spans, data in zip(new, pii.model_spans(model, new), ("maria.klein(at)example.com", "maria.klein at example dot com"), strict=True):
        at = text.index(data)
        assert [s[0] for s in spans] == ["email"] and abs(spans[0][1] - at) <= 2 and abs(spans[0][2] - at - len(data)) <= 2
    plain = [filler(60) for _ in range(100)]
    assert sum(map(len, pii.model_spans(model, plain))) <= 1
    redacted = pii.redact(frame(spark, list(enumerate(new))), model).collect()
    assert all("<email>" in r.text for r in redacted)


def test_decoding_between_sure_places_gives_the_best_path():
    rng = np.random.default_rng(8)
    step = rng.standard_normal((pii.TAGS, pii.TAGS)).astype(np.float32)
    sizes = [0, 1, 40, 300, 7]
    s = rng.standard_normal((sum(sizes), pii.TAGS)).astype(np.float32)
    s[:, 0] += 30 * (rng.random(len(s)) < 0.6)
    offs = np.concatenate(([0], np.cumsum(sizes)))
    got = pii.best_tags(s, offs, step)
    for a, b in zip(offs[:-1], offs[1:], strict=True):
        if b > a:
            assert (got[a:b] == pii.viterbi(s[None, a:b], step)[0]).all()
    p = pii.initial()
    x = rng.integers(0, 129, (5, pii.WIDTH))
    e = p["embed"][x.T]
    both = np.concatenate((pii._lstm(p, "f", e), pii._lstm(p, "b", e[::-1])[::-1]), 2)
    assert np.abs(pii.scores(p, x) - (both @ p["out"] + p["bias"]).transpose(1, 0, 2)).max() < 1e-4


def test_pii_odd_rows(odd, empty):
    assert pii.fit(empty) is None
    rows = pii.find(odd, None).collect()
    assert len(rows) == len(odd_rows()) and all(r.spans == r.base for r in rows)
    assert pii.redact(odd, None).where("doc_id = 1").first().text is None


def test_crf_gradient_is_the_derivative():
    rng = np.random.default_rng(1)
    s, step = rng.standard_normal((6, 3, pii.TAGS)), rng.standard_normal((pii.TAGS, pii.TAGS))
    y = rng.integers(0, pii.TAGS, (6, 3))
    loss, ds, dstep = pii._crf_gradient(s, y, step)
    bumped = s.copy()
    bumped[2, 1, 3] += 1e-5
    assert abs((pii._crf_gradient(bumped, y, step)[0] - loss) / 1e-5 - ds[2, 1, 3]) < 1e-4
    turn = step.copy()
    turn[1, 2] += 1e-5
    assert abs((pii._crf_gradient(s, y, turn)[0] - loss) / 1e-5 - dstep[1, 2]) < 1e-4


# --- fingerprints ---

def test_fingerprints(docs, texts, odd, empty):
    rows = {r.doc_id: r for r in fingerprint.compare_edits(docs).collect()}
    ids = sorted(texts)
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        t = texts[i]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + texts[j][:cut]
        assert rows[i].n_chars == len(t) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    by_text = defaultdict(set)
    for i in ids:
        by_text[texts[i]].add(rows[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert sum(r.near_edited for r in rows.values()) > 3 * sum(r.near_next for r in rows.values())
    got = fingerprint.compare_edits(odd).collect()
    assert len(got) == len(odd_rows()) and all(r.fingerprint == "" for r in got if r.doc_id in (1, 2, 3))
    assert fingerprint.compare_edits(empty).count() == 0


# --- BPE ---

@pytest.mark.parametrize("common", [1 << 18, 40])
def test_bpe_round_trip(docs, texts, odd, empty, common, monkeypatch):
    monkeypatch.setattr(bpe, "COMMON_WORDS", common)
    path = tokenizer_path()
    tokenizer = bpe.load(path)
    for r in bpe.digests(bpe.encode(docs, path), path).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)))
    got = bpe.encode(odd, path).collect()
    assert sorted(len(r.ids) for r in got) == sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in odd_rows())
    assert bpe.decode(bpe.encode(empty, path), path).count() == 0


def test_bpe_splits_where_the_tokenizer_does(spark):
    path = tokenizer_path()
    tokenizer = bpe.load(path)
    hard = ["it's I'LL don't.", "a<|endoftext|>b, <|startoftext|>", "é. café!x", " nbsp em", "3.14,15 a.b.c",
            "ΣΑΣ. İx", "x​y 日本語。テスト", "tabs\tand\x0bfeeds\x0c\r\n end"]
    rows = bpe.encode(frame(spark, list(enumerate(hard))), path).collect()
    for r in rows:
        assert r.ids == tokenizer.encode(hard[r.doc_id], add_special_tokens=False).ids


# --- language ---

def test_languages_of_held_out_documents(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    rows = language_id.predict(docs, model).where("held_out").join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[4].lang_pred != "und"
    assert language_id.fit(empty) is None and language_id.predict(odd, None).where("lang_pred <> 'und'").isEmpty()


def test_probabilities_of_a_context_add_up_to_one():
    text = "the then there theme other mother father" * 3
    *_, key, _, _ = next(language_id.slices([text]))
    keys, n = np.unique(key, return_counts=True)
    model = language_id.Model({"x": (keys, n)})
    every = np.array(sorted({ord(c) for c in text}), np.uint64)
    context = np.uint64(0)
    for c in "the":
        context = (context << np.uint64(16)) | np.uint64(ord(c))
    total = model.probabilities(4, (context << np.uint64(16)) | every).sum()
    assert 0.95 < total < 1 + 1e-9  # the rest is for a character never seen


# --- repeated strings ---

def brute_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = t.encode()
        mark = bytearray(len(raw))
        for s in range(len(raw) - 99):
            piece = raw[s:s + 100]
            if piece in seen:
                mark[s:s + 100] = b"\1" * 100
            seen.add(piece)
        out[i] = (len(raw), sum(mark), len([x for x in bytes(mark).split(b"\0") if x]), bytes(c for c, m in zip(raw, mark, strict=True) if not m))
    return out


@pytest.mark.parametrize("hot", [5000, 1])
def test_repeats_match_brute_force(spark, docs, texts, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(suffix_dedup, "COLLECTION_BYTES", 2000)
    rows = [(1000 + i, t or "") for i, (_, t) in enumerate(odd_rows())] + sorted(texts.items())[:60]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute_repeats(rows)


def test_equal_anchors_without_an_equal_window(spark):
    draw = np.random.default_rng(8)
    own = ["".join(map(chr, draw.integers(97, 123, 150))) for _ in range(6)]
    rows = [(i, own[2 * i] + PASSAGE[:90] + own[2 * i + 1]) for i in range(3)]  # 90 bytes in common: no window, but anchors
    hashes = [set(suffix_dedup.segments(*next(common.chunks(pa.array([t])))[2:])[4].tolist()) for _, t in rows]
    assert set.intersection(*hashes)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute_repeats(rows) == {i: (390, 0, 0, t.encode()) for i, t in rows}


def test_repeats_odd_rows_and_long_texts(spark, odd, empty, monkeypatch):
    assert suffix_dedup.remove_repeats(odd).count() == len(odd_rows())
    assert suffix_dedup.remove_repeats(empty).count() == 0
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 500)
    long = "".join(chr(97 + i * i % 23) + chr(97 + i * 31 % 19) for i in range(1500))
    rows = [(1, long + PASSAGE), (2, "é" * 40 + PASSAGE + long[700:1900])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute_repeats(rows)


# --- chunks ---

def test_chunks_cover_the_text_and_resist_insertions():
    data = np.frombuffer((PASSAGE * 3 + " é日本 ").encode() * 4, np.uint8)
    ends = substring_dedup.boundaries(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    moved = np.concatenate((np.frombuffer(b"some new head words ", np.uint8), data))

    def pieces(d):
        cuts = substring_dedup.boundaries(d)
        return {d[a:b].tobytes() for a, b in zip([0, *cuts[:-1]], cuts, strict=True)}

    assert len(pieces(data) & pieces(moved)) >= 0.7 * len(pieces(data))


@pytest.mark.parametrize("alphabet", [[chr(0x4E00 + k) for k in range(600)], [chr(0x0E01 + k) for k in range(40)],
                                      list("abcdefghijklmnopqrstuvwxyz\u00a0\u3000"), list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefgh+/0123456789")])
def test_chunks_of_text_without_ascii_spaces_resist_insertions(spark, alphabet):
    rng = np.random.default_rng(4)
    own = lambda n: "".join(rng.choice(alphabet, n))
    passage = own(900)
    rows = [(i, own(50 + 7 * i) + passage + own(60)) for i in range(5)]
    for _, text in rows:
        raw = text.encode()
        ends = substring_dedup.boundaries(np.frombuffer(raw, np.uint8))
        assert ends[-1] == len(raw) and all(raw[a:b].decode() for a, b in zip([0, *ends[:-1]], ends, strict=True))
        assert max(np.diff([0, *ends])) <= substring_dedup.MAX_BYTES
    got = {r.doc_id: r for r in substring_dedup.cut_repeats(frame(spark, rows)).collect()}
    assert got[0].n_removed == 0 and all(got[i].n_removed >= 0.85 * len(passage.encode()) for i in range(1, 5))


def test_repeated_passages_are_cut_once(spark, odd, empty):
    rng = np.random.default_rng(9)
    own = lambda: " ".join(f"u{x}" for x in rng.integers(0, 10 ** 6, 60))
    rows = [(i, f"{own()} {PASSAGE} {own()}") for i in range(6)] + [(99, own())]
    got = {r.doc_id: r for r in substring_dedup.cut_repeats(frame(spark, rows)).collect()}
    assert got[0].n_removed == got[99].n_removed == 0
    for i in range(1, 6):
        assert got[i].n_removed >= 0.5 * len(PASSAGE) and got[i].n_spans == 1
        assert len(got[i].text.encode()) + got[i].n_removed == len(rows[i][1].encode()) and got[i].n_chars == len(got[i].text)
    again = {r.doc_id: r.text for r in substring_dedup.cut_repeats(odd).collect()}
    assert again[1] is None and again[2] == ""
    assert substring_dedup.cut_repeats(empty).count() == 0


def test_passages_of_51_words_are_cut_as_a_whole(spark):
    rng = np.random.default_rng(12)
    word = lambda k: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), k))
    rows, passages = [], []
    for i in range(400):
        passages.append(" ".join(word(2 + i % 5) for _ in range(51)))
        rows += [(2 * i + k, f"{' '.join(word(7) for _ in range(20 + k))} {passages[-1]} {' '.join(word(7) for _ in range(20))}")
                 for k in range(2)]
    got = {r.doc_id: r for r in substring_dedup.cut_repeats(frame(spark, rows)).collect()}
    for i, passage in enumerate(passages):
        assert got[2 * i].text == rows[2 * i][1]
        first, last = rows[2 * i + 1][1].split(passage)
        assert got[2 * i + 1].n_spans == 1 and got[2 * i + 1].text.split() == (first + last).split()


def test_passages_of_51_chinese_characters_are_cut_as_a_whole(spark):
    rng = np.random.default_rng(13)
    own = lambda n: "".join(chr(x) for x in rng.integers(0x4E00, 0x9F00, n))
    rows, left = [], {}
    for i in range(200):
        passage, head, tail = own(51), own(40 + i % 7), own(40)
        rows += [(2 * i, own(40) + passage + own(30)), (2 * i + 1, head + passage + tail)]
        left[2 * i + 1] = head + tail
    got = {r.doc_id: r.text for r in substring_dedup.cut_repeats(frame(spark, rows)).collect()}
    assert all(got[i] == text for i, text in left.items())


# --- packing ---

def test_bins_hold_the_constraints(docs, odd, empty):
    rows = packing.best_fit(docs, packing.text_cluster(F.col("text")), capacity=512, shard_words=20000).collect()
    meta = {r.doc_id: r for r in docs.select("doc_id", "source", packing.text_cluster(F.col("text")).alias("c"), packing.word_count(F.col("text")).alias("n")).collect()}
    bins, words = defaultdict(list), Counter()
    for r in rows:
        words[r.doc_id] += r.n_words
        if r.bin is not None:
            bins[r.shard, r.bin].append(r)
    assert dict(words) == {i: m.n for i, m in meta.items()}
    for own in bins.values():
        assert sum(r.n_words for r in own) + own[0].residual == 512 and own[0].residual >= 0
        clusters = [meta[r.doc_id].c for r in own]
        assert len(clusters) == len(set(clusters))
        assert max(Counter(meta[r.doc_id].source for r in own).values()) <= packing.SOURCE_SHARE
    assert packing.best_fit(odd, packing.text_cluster(F.col("text"))).count() == len(odd_rows())
    assert packing.best_fit(empty, packing.text_cluster(F.col("text"))).count() == 0


def test_tightest_compatible_bin_is_taken():
    assert packing.pack([6, 5, 4, 3], [0, 1, 2, 3], [0, 1, 2, 3], 10) == [(0, 0, 0), (1, 0, 2), (0, 1, 0), (1, 1, 2)]
    assert packing.pack([6, 5, 4], [0, 1, 2], [0, 1, 0], 10) == [(0, 0, 4), (1, 0, 1), (1, 1, 1)]
    assert [b for b, _, _ in packing.pack([2] * 5, [0] * 5, [-1] * 5, 10, source_share=2)] == [0, 0, 1, 1, 2]


# --- licenses ---

def test_license_hits(spark, docs, texts, odd, empty):
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, t in texts.items():
        planted = [n for n, notice in licenses.NOTICES if notice in t]
        assert (rows[i].license in planted) if planted else rows[i].license is None
    long = "the " * 3000 + "This software is Licensed under the Apache License Version 2.0 and " + "of " * 3000 + "released under MIT License"
    got = licenses.scan(frame(spark, [(1, long)])).first()
    assert {h.license for h in got.hits} >= {"Apache-2.0"} and got.n_hits >= 1
    assert all(r.license is None for r in licenses.scan(odd).collect()) and licenses.scan(empty).count() == 0


def test_alignment_is_increasing_and_equal():
    a, b = "a x b y c z a".split(), "a b c q a".split()
    pairs = licenses.align(a, b)
    assert pairs == sorted(pairs) and all(a[i] == b[j] for i, j in pairs) and len(pairs) == 4


# --- pipeline ---

def test_pipeline_stages_match_their_operators(spark):
    steps = dict(corpus_pipeline.STAGES)
    start = spark.read.parquet(f"{SF}/documents.parquet")
    kept = steps["quality_rules"](spark, start, SF)
    assert kept.columns == list(corpus_pipeline.COLUMNS) and 0 < kept.count() < start.count()
    kept = kept.cache()
    one = steps["near_dedup"](spark, kept, SF)
    brute = brute_components({r.doc_id: r.text for r in kept.collect()})
    assert {r.doc_id for r in one.collect()} == {i for i, (_, c) in brute.items() if i == c}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in one.collect()}
