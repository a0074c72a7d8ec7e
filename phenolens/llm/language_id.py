"""Language identification with interpolated Kneser-Ney character models.

One model per language: character n-grams of up to ``ORDER`` (lower case,
digits as one sign, white space as blanks). The highest order uses counts, the
lower ones continuation counts (in how many contexts an n-gram was seen), each
with an absolute discount; what the discount frees goes to the next lower
order. All n-grams of an order lie in one sorted array of 64-bit keys (16 bits
a character), beside it a row of probabilities, one for each language; contexts
lie in another with their back-off weights. A text takes the language with the
lowest cross-entropy per character; equal ones go to the first by name.

The score is the share of the best language in a softmax of the negative
cross-entropies. ``rejected`` marks texts whose best cross-entropy is above what
all but one in a thousand of that language's training texts reach (plus
``SLACK``): calibrated rejection leaves the prediction as it is and says that
it should not be trusted.

The models are fitted to about ``DOCS_PER_LANGUAGE`` documents of each
language, chosen by a hash of the id (the documented bound); the counts are
made by Spark. Every text is scored whole.

Cases: a null text, and one without any letter, is ``und`` with score 0 and
not rejected. Rows are judged one by one; repeated rows get equal results; a
null ``doc_id`` is not learned from and not held out. Without any labelled
row every text is ``und``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import renamed, written

ORDER = 4
DOCS_PER_LANGUAGE = 1500
SLACK = 0.25
SHARPNESS = 8.0
CHUNK_CHARS = 1 << 19
_BITS = np.uint64(16)


@lru_cache(maxsize=1)
def _signs() -> tuple[np.ndarray, np.ndarray]:
    """(sign of every 16-bit code point, whether it is a letter)."""
    sign = np.arange(1 << 16, dtype=np.uint64)
    letter = np.zeros(1 << 16, bool)
    for c in range(1 << 16):
        x = chr(c)
        letter[c] = x.isalpha()
        low = x.lower()
        if x.isspace():
            sign[c] = ord(" ")
        elif x.isdigit():
            sign[c] = ord("0")
        elif len(low) == 1:
            sign[c] = ord(low)
    return sign, letter


def slices(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, keys of all n-grams, row of each, whether a row has a letter)."""
    sign, letter = _signs()
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK_CHARS):
            size += len(texts[hi])
            hi += 1
        own = texts[lo:hi]
        lead = " " * (ORDER - 1)
        points = np.frombuffer((lead + lead.join(own)).encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.array([len(t) for t in own], np.int64)
        start = np.cumsum(length + ORDER - 1) - length
        row = np.repeat(np.arange(len(own)), length)
        at = np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)
        low = np.minimum(points, 0xFFFF).astype(np.int64)
        has = np.zeros(len(own), bool)
        has[row[letter[low[at]]]] = True
        for i in np.unique(row[points[at] > 0xFFFF]).tolist():
            has[i] |= any(c.isalpha() for c in own[i])
        s = sign[low]
        key = np.zeros(len(at), np.uint64)
        for k in range(ORDER):
            key = (key << _BITS) | s[at - (ORDER - 1 - k)]
        yield lo, hi, key, row, has
        lo = hi


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lo, hi, key, row, _ in slices(texts):
            for lang in sorted(set(langs[lo:hi])):
                keys, n = np.unique(key[(langs[lo:hi] == lang)[row]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"])


class Model:
    """Interpolated Kneser-Ney models of several languages in shared sorted arrays."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        self.cutoff = np.full(len(self.languages), np.inf)
        signs = {int(x) for keys, _ in counts.values() for x in np.unique(keys & np.uint64(0xFFFF))}
        self.uniform = 1.0 / (len(signs) + 1)
        self.keys: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.p: list[np.ndarray] = [np.zeros((0, len(self.languages)))]
        self.contexts: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.back: list[np.ndarray] = [np.zeros((0, len(self.languages)))]
        by_order = {lang: self._counts_by_order(*counts[lang]) for lang in self.languages}
        for order in range(1, ORDER + 1):
            self._add(order, [by_order[lang][order] for lang in self.languages])

    @staticmethod
    def _counts_by_order(keys: np.ndarray, n: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        out = {ORDER: (keys, n)}
        for order in range(ORDER - 1, 0, -1):
            mask = np.uint64((1 << 16 * order) - 1)
            out[order] = np.unique(out[order + 1][0] & mask, return_counts=True)  # in so many contexts
        return out

    def _add(self, order: int, per_language: list[tuple[np.ndarray, np.ndarray]]) -> None:
        keys = np.unique(np.concatenate([k for k, _ in per_language]))
        contexts = np.unique(keys >> _BITS)
        p, back = np.zeros((len(keys), len(per_language))), np.ones((len(contexts), len(per_language)))
        lower = self.probabilities(order - 1, keys & np.uint64((1 << 16 * (order - 1)) - 1))
        at = np.searchsorted(contexts, keys >> _BITS)
        for j, (own, n) in enumerate(per_language):
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = once / (once + 2 * twice) if once and once + 2 * twice else 0.5
            place = np.searchsorted(contexts, own >> _BITS)
            total = np.bincount(place, n, minlength=len(contexts))
            kinds = np.bincount(place, minlength=len(contexts))
            seen = total > 0
            back[seen, j] = discount * kinds[seen] / total[seen]
            p[np.searchsorted(keys, own), j] = np.maximum(n - discount, 0) / total[place]
            p[:, j] += back[at, j] * lower[:, j]
        self.keys.append(keys)
        self.p.append(p)
        self.contexts.append(contexts)
        self.back.append(back)

    def probabilities(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Probability of the last character after the others, in each language."""
        if order == 0:
            return np.full((len(keys), len(self.languages)), self.uniform)
        own = self.keys[order]
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        out = self.p[order][at]
        new = np.flatnonzero(own[at] != keys)
        if len(new):
            context = keys[new] >> _BITS
            c = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            back = np.where((self.contexts[order][c] == context)[:, None], self.back[order][c], 1.0)
            out[new] = back * self.probabilities(order - 1, keys[new] & np.uint64((1 << 16 * (order - 1)) - 1))
        return out

    def cross_entropies(self, key: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Of each row in each language, in nats per character (0 for a row without n-grams)."""
        logs = np.log(self.probabilities(ORDER, key))
        n = np.bincount(row, minlength=rows)
        total = np.stack([np.bincount(row, logs[:, j], minlength=rows) for j in range(logs.shape[1])], 1)
        return -total / np.maximum(n, 1)[:, None]


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            langs, scores, entropies, rejected = [], [], [], []
            for lo, hi, key, row, has in slices(texts):
                rows = hi - lo
                if model is None:
                    best, h = np.zeros(rows, int), np.zeros((rows, 1))
                    has[:] = False
                else:
                    h = model.cross_entropies(key, row, rows)
                    best = h.argmin(1)
                least = h[np.arange(rows), best]
                share = 1 / np.exp(-SHARPNESS * (h - least[:, None])).sum(1)
                for i in range(rows):
                    langs.append(model.languages[best[i]] if has[i] else "und")
                    scores.append(float(share[i]) if has[i] else 0.0)
                    entropies.append(float(least[i]) if has[i] else None)
                    rejected.append(bool(has[i] and least[i] > model.cutoff[best[i]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(entropies, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return run


def held_out(doc_id):
    """crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Models of all languages among the rows that are not held out."""
    own = renamed(docs, {id_col: "doc_id", text_col: "text", lang_col: "lang"})
    own = own.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.create_map(*(x for lang, n in sorted(sizes.items()) for x in (F.lit(lang), F.lit(int(1e9 * min(1.0, DOCS_PER_LANGUAGE / n))))))
    sample = written(own.where(F.pmod(F.xxhash64("doc_id"), F.lit(10 ** 9)) < share[F.col("lang")]), "language-sample")
    rows = (sample.mapInArrow(_count_batches, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    lang, gram, n = (rows.column(c).to_numpy() for c in ("lang", "gram", "n"))
    counts = {}
    for x in sorted(set(lang)):
        own_keys, own_n = gram[lang == x].view(np.uint64), n[lang == x]
        order = np.argsort(own_keys)
        counts[x] = (own_keys[order], own_n[order])
    if not counts:
        return None
    model = Model(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    reached = (sample.select("doc_id", "text").mapInArrow(
        _predict(shared), "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
        .groupBy("lang_pred").agg(F.percentile("cross_entropy", F.lit(0.999)).alias("most")).collect())
    for r in reached:
        if r.lang_pred in model.languages and r.most is not None:
            model.cutoff[model.languages.index(r.lang_pred)] = r.most + SLACK
    return model


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = renamed(docs, {id_col: "doc_id", text_col: "text"}).mapInArrow(
        _predict(shared), "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
