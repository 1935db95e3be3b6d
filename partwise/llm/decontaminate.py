"""Benchmark passages in documents, by latent semantic retrieval and two exact checks.

Words of the benchmark are the terms. Documents are read as passages of `WINDOW` words; a passage is the
TF-IDF vector of its terms (counts by inverse frequency), with frequencies over the passages of all documents. One
distributed pass over them gives a randomised SVD: every task sums A^T (A R) for a fixed random R over
its passages, the sums are added by term, and the few columns are factored. In that latent space,
scaled by the singular values, passages of documents (of two lengths, overlapping by half) and of the
benchmark are compared by cosine. A candidate has to share enough words with the item, and then the longest
common subsequence of words decides: a near-verbatim copy by itself, a paraphrase only if the words of
the item's answer are there too. Terms are also marked as bits, by window and around it: where more of an item's bits
lack than words may, the words are not compared.

The benchmark is searched in blocks of a bounded number of items, which are what is broadcast.
"""

from __future__ import annotations

import re
from itertools import repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.tables import id_and_text, in_slices, materialise

WINDOW, STEP = 32, 16
RANK = 96
LEAST_COSINE = 0.3
# Windows in which documents are searched: words, step, and the share of a benchmark passage's words that has
# to be in one before the subsequence is sought. The short ones are for short items and thin paraphrases.
VIEWS = ((WINDOW, STEP, 0.3), (16, 8, 0.25))
GRAIN = 8  # words whose latent vectors are added once; short windows are two of these, long ones two short ones
# Bits in which the terms of a place are marked, those around it and its own: what lacks too many is compared no further.
BITS, NARROW = 1024, 256
TEXTS_AT_ONCE, WORDS_AT_ONCE = 64, 1 << 17  # whose latent vectors a task holds; of more words, one text
WINDOWS = 1024  # whose latent vectors are held at once
PAIRS = 1 << 15  # of windows and benchmark passages compared word by word at once
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.5
SHORT = 12  # items of fewer words are found as a run of just these words
# Bounds of what is broadcast for one pass over the documents.
ITEMS_PER_BLOCK, WORDS_PER_BLOCK = 2000, 100_000
# ASCII that is no letter or digit separates words
SEPARATORS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode().translate(SEPARATORS).split()


class Items:
    """A block of benchmark items: their words as term numbers, answers, and passages."""

    def __init__(self, rows: list[tuple[int, str, str | None]]) -> None:
        self.terms: dict[bytes, int] = {}
        self.ids, self.words, self.answers = [], [], []
        for item, text, answer in rows:
            cut = words(text or "")
            if not cut:
                continue
            sentences = [s for s in re.split(r"[.!?]+\s", text) if words(s)]
            told = words(answer) if answer is not None else words(sentences[-1])
            number = lambda ws: [self.terms.setdefault(w, len(self.terms)) for w in ws]
            self.ids.append(item)
            self.words.append(np.array(number(cut), np.int32))
            self.answers.append(set(number(told)))
        long = [i for i, w in enumerate(self.words) if len(w) >= SHORT]
        self.short = [i for i, w in enumerate(self.words) if len(w) < SHORT]
        cuts = [(i, s) for i in long for s in range(0, max(1, len(self.words[i]) - STEP), STEP)]
        self.item = np.array([i for i, _ in cuts], np.int64)
        self.passages = [self.words[i][s : s + WINDOW] for i, s in cuts]
        self.masks = [_masks(w) for w in self.words]

    def plain(self) -> SimpleNamespace:
        """What tasks need, without a class of this package: it need not be installed there."""
        return SimpleNamespace(**vars(self))

    def vectors(self, idf: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.passages), len(idf)), np.float32)
        for row, passage in zip(out, self.passages):
            term, n = np.unique(passage, return_counts=True)
            row[term] = (1 + np.log(n)) * idf[term]
        return out


def _told(answer: set[int], region: list[int]) -> float:
    """Share of the answer's words that are in a region."""
    return len(answer.intersection(region)) / len(answer) if answer else 0.0


def _masks(terms: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        masks[t] = masks.get(t, 0) | 1 << i
    return masks


def common_subsequence(masks: dict[int, int], n: int, other: list[int]) -> int:
    """Length of the longest common subsequence of n words, given as bit masks, and other words."""
    full = (1 << n) - 1
    row = full
    for t in other:
        if hit := masks.get(t):
            up = row & hit
            row = ((row + up) | (row - up)) & full
    return n - row.bit_count()


def _laid_out(values: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of the lengths in rows of `size`, each from a row of its own, filled up with -1, as is a row behind them; each list's first row."""
    first = np.concatenate([[0], np.cumsum(np.maximum(1, -(-lengths // size)))])
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows = np.full((int(first[-1]) + 1) * size, -1, np.int64)
    rows[np.repeat(first[:-1] * size, lengths) + place] = values
    return rows.reshape(-1, size), first


def _words_in_rows(texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    return _laid_out(np.concatenate(texts), np.array([len(t) for t in texts]), size)


def _counts(passages: np.ndarray, n_terms: int) -> tuple[np.ndarray, ...]:
    """Counts of terms by passage, which are rows of WINDOW words: (passage, term, count)."""
    words_of = passages.ravel()
    hit = np.flatnonzero(words_of >= 0)
    key, n = np.unique(hit // WINDOW * n_terms + words_of[hit], return_counts=True)
    return key // n_terms, key % n_terms, n


def _with_zeros(table: np.ndarray) -> np.ndarray:
    return np.vstack([table, np.zeros((1, table.shape[1]), table.dtype)])  # row -1: no term


def _over_words(table: np.ndarray, rows: np.ndarray, add=np.add) -> np.ndarray:
    """What the words of each row have in a table by term, added."""
    out = table.take(rows[:, 0], 0)
    for i in range(1, rows.shape[1]):
        add(out, table.take(rows[:, i], 0), out=out)
    return out


def _bits_of_terms(n_terms: int) -> np.ndarray:
    """One bit of BITS for each term, none for -1."""
    out, term = np.zeros((n_terms + 1, BITS // 64), np.uint64), np.arange(n_terms)
    out[term, term % BITS // 64] = np.uint64(1) << (term % 64).astype(np.uint64)
    return out


def _bits_of(bits: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    return np.array([np.bitwise_or.reduce(bits[s]) for s in sets], np.uint64).reshape(-1, bits.shape[1])


def _narrow(signs: np.ndarray) -> np.ndarray:
    return np.bitwise_or.reduce(signs.reshape(len(signs), -1, NARROW // 64), 1)


def _unions(signs: np.ndarray, longest: int) -> np.ndarray:
    """Bits of the 1, 2, 4, ... rows from each row on, up to the longest run of rows that is asked for."""
    out = np.empty((max(1, longest).bit_length(), *signs.shape), signs.dtype)
    out[0] = signs
    for level in range(1, len(out)):
        half = 1 << level - 1
        out[level] = out[level - 1]
        out[level, :-half] |= out[level - 1, half:]
    return out


def _missing(signs: np.ndarray, which: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Bits of each of `which` that are not there: so many of its words at least are not."""
    return np.bitwise_count(signs.take(which, 0) & ~there).sum(1, dtype=np.int64)


def _add_runs(total: np.ndarray, keys: np.ndarray, at: np.ndarray, table: np.ndarray) -> None:
    """Adds rows `at` of a table, whose last is zeros, to those of total that keys name; equal keys lie together."""
    while len(keys):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        if len(starts) == len(keys):
            total[keys] += table.take(at, 0)
            return
        rows, first = _laid_out(at, np.diff(starts, append=len(keys)), 4)  # four at a time: faster than reduceat
        table = _over_words(table, rows)
        keys = np.repeat(keys[starts], np.diff(first))
        at = np.arange(len(keys))


def _terms(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return [np.frombuffer(t, np.int32) for t in batch.column(column).to_pylist()]


def _slices(batches):
    """Slices of record batches and their texts: TEXTS_AT_ONCE, or fewer where they are long."""
    for batch in in_slices(batches, TEXTS_AT_ONCE):
        texts = _terms(batch, 0)
        part = np.cumsum([len(t) for t in texts]) // WORDS_AT_ONCE
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(texts)]):
            yield batch.slice(a, b - a), texts[a:b]


def numbered(docs: DataFrame, items, id_col: str, text_col: str) -> DataFrame:
    """Documents as term numbers (-1: no term of the benchmark), and for each task the frequencies."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def number(batches):
        get = items.value.terms.get
        n_terms, seen, passages = len(items.value.terms), None, 0
        for batch in in_slices(batches):
            cut = [raw.decode("utf-8", "replace") for raw in batch.column(1).to_pylist()]
            texts = [np.fromiter(map(get, ws, repeat(-1)), np.int32, len(ws)) for ws in map(words, cut)]
            rows, first = _words_in_rows(texts, WINDOW)
            found = np.bincount(_counts(rows, n_terms)[1], minlength=n_terms)
            seen, passages = found if seen is None else seen + found, passages + int(first[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.tobytes() for t in texts], pa.binary()), pa.nulls(len(texts), pa.list_(pa.int64())), pa.nulls(len(texts), pa.int64())],
                ["id", "terms", "seen", "passages"],
            )
        if seen is not None:
            id_ = pa.nulls(1, batch.column(0).type)
            yield pa.RecordBatch.from_arrays(
                [id_, pa.nulls(1, pa.binary()), pa.array([seen.tolist()], pa.list_(pa.int64())), pa.array([passages], pa.int64())],
                ["id", "terms", "seen", "passages"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        number, f"id {id_type}, terms binary, seen array<long>, passages long"
    )


def latent_space(texts: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors of all passages, each divided by its singular value: terms by rank."""
    n_terms, rank = len(idf), min(rank, len(idf))
    start = np.random.default_rng(0).normal(size=(n_terms, rank))
    shared = texts.sparkSession.sparkContext.broadcast((idf, start.astype(np.float32)))

    def project(batches):
        idf, start = shared.value
        total = np.zeros((n_terms, rank))
        weighted = _with_zeros(start * idf[:, None])
        for _, texts in _slices(batches):
            rows, first = _words_in_rows(texts, WINDOW)
            passage, term, n = _counts(rows, n_terms)
            value = (n * idf[term]).astype(np.float32)
            square = np.maximum(np.bincount(passage, value * value, minlength=first[-1]), 1e-9).astype(np.float32)
            reduced = _over_words(weighted, rows)
            # rows of A are of length 1: one division for A and one for its transpose
            reduced[:-1] /= square[:, None]
            for a in range(0, len(rows), WINDOWS):  # long texts have many words, and a row for each
                at = rows[a : a + WINDOWS].ravel()
                order = np.flatnonzero(at >= 0)
                order = order[np.argsort(at[order].astype(np.min_scalar_type(n_terms)), kind="stable")]
                _add_runs(total, at[order], a + order // WINDOW, reduced)
        total *= idf[:, None]
        rows = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows), *[pa.array(total[rows, i]) for i in range(rank)]], ["term", *[f"c{i}" for i in range(rank)]])

    schema = ", ".join(["term long", *[f"c{i} double" for i in range(rank)]])
    sums = texts.select("terms").mapInArrow(project, schema).groupBy("term").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(rank)])
    gram = np.zeros((n_terms, rank))
    for r in sums.collect():  # a row for each term of the block
        gram[r["term"]] = r[1:]
    # A^T A from its product with the random columns: the single-pass way for a symmetric matrix
    shift = 1e-6 * np.linalg.norm(gram) + 1e-12
    gram = gram + shift * start
    core = start.T @ gram
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-9 * values.max()
    u, s, _ = np.linalg.svd(gram @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    return (u / np.maximum(s, 1e-9)).astype(np.float32)


def _runs_of(short: list[int], items, texts: list[np.ndarray], idf: np.ndarray):
    """(text, item, first word) where the words of a short item lie in a row: looked for at its rarest word."""
    anchors: dict[int, list[tuple[int, int]]] = {}
    for item in short:
        own = items.words[item]
        at = int(np.argmax(idf[own]))
        anchors.setdefault(int(own[at]), []).append((item, at))
    is_anchor = np.zeros(len(idf) + 1, bool)  # -1, no term, is the last
    is_anchor[list(anchors)] = True
    for t, text in enumerate(texts):
        for place in np.flatnonzero(is_anchor[text]).tolist():
            for item, at in anchors[int(text[place])]:
                own, lo = items.words[item], place - at
                if lo >= 0 and np.array_equal(text[lo : lo + len(own)], own):
                    yield t, item, lo


def _candidates(texts: list[np.ndarray], items, model) -> list[list[tuple[int, int, int, float]]]:
    """For each of VIEWS, (text, benchmark passage, first word, cosine) of near windows, but for those that lack too
    many words of the passage, or with the words around them too many of the item, by the bits of their terms."""
    rows, first = _words_in_rows(texts, GRAIN)
    n_words = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    row, last = np.arange(len(text)), len(text)
    place = (row - first[text]) * GRAIN

    def after(n: int) -> np.ndarray:
        return np.where(row + n < first[text + 1], row + n, last)

    lengths = np.array([len(w) for w in items.words])
    sizes = np.array([len(p) for p in items.passages])
    # windows from each row on: two rows, and then two of these; the last row has no terms
    latent, signs = _over_words(model.weighted, rows), _over_words(model.bits, rows, np.bitwise_or)
    around = _unions(signs, int(min(2 * lengths.max() + WINDOW, n_words.max())) // GRAIN + 2)
    signs = _narrow(signs)
    found: list[list[tuple[int, int, int, float]]] = []
    for n_rows, (window, step, least_shared) in zip((1, 2), reversed(VIEWS)):
        latent[:-1] += latent.take(after(n_rows), 0)
        signs[:-1] |= signs.take(after(n_rows), 0)
        begin = np.flatnonzero((place % step == 0) & ((place == 0) | (place < n_words[text] - window + step)))
        found.insert(0, [])
        for a in range(0, len(begin), WINDOWS):
            at = begin[a : a + WINDOWS]
            reduced = latent.take(at, 0)
            reduced /= np.maximum(np.linalg.norm(reduced, axis=1), 1e-9)[:, None]
            cosine = reduced @ model.latent.T
            near = np.flatnonzero(cosine.ravel() >= LEAST_COSINE)
            for b in range(0, len(near), PAIRS):
                which, k = np.divmod(near[b : b + PAIRS], len(sizes))
                enough = sizes[k] - _missing(model.passage_bits, k, signs.take(at[which], 0)) >= least_shared * sizes[k]
                which, k = which[enough], k[enough]
                t, start, length = text[at[which]], place[at[which]], lengths[items.item[k]]
                low = first[t] + np.maximum(0, start - length) // GRAIN
                n = first[t] + -(-np.minimum(n_words[t], start + window + length) // GRAIN) - low
                level = np.frexp(n)[1] - 1
                there = around[level, low] | around[level, low + n - (1 << level)]
                enough = length - _missing(model.item_bits, items.item[k], there) >= PARAPHRASE * length
                found[0] += zip(*[x[enough].tolist() for x in (t, k, start, cosine[which, k])])
    return found


def _matches(texts: list[np.ndarray], items, model):
    """(text, item, similarity, cosine, first word) of what passes all checks."""
    best: dict[tuple[int, int], tuple[float, float, int]] = {}
    there = np.zeros(len(model.idf) + 1, bool)  # -1, no term, is the last
    for (window, _, least_shared), near in zip(VIEWS, _candidates(texts, items, model) if items.passages else ()):
        for t, k, start, close in near:
            item = int(items.item[k])
            if best.get((t, item), (0,))[0] == 1.0:
                continue
            own, lo = items.words[item], max(0, start - len(items.words[item]))
            region = texts[t][lo : start + window + len(own)]
            there[region] = True
            hope = np.count_nonzero(there[own])  # no subsequence is longer
            there[region] = False
            if hope < PARAPHRASE * len(own):
                continue
            term, n = np.unique(texts[t][start : start + window], return_counts=True)
            if np.minimum(n, model.counts[k, term] * (term >= 0)).sum() < least_shared * len(items.passages[k]):
                continue
            region = region.tolist()
            similar = common_subsequence(items.masks[item], len(own), region) / len(own)
            if similar >= VERBATIM or similar >= PARAPHRASE and _told(items.answers[item], region) >= ANSWER:
                best[t, item] = max(best.get((t, item), (0.0, 0.0, 0)), (similar, close, lo))
    for t, item, lo in _runs_of(items.short, items, texts, model.idf) if items.short else ():
        best.setdefault((t, item), (1.0, 1.0, lo))
    return [(t, i, *b) for (t, i), b in best.items()]


def _model(items: Items, idf: np.ndarray, space: np.ndarray) -> SimpleNamespace:
    latent = items.vectors(idf) @ space if items.passages else np.zeros((0, space.shape[1]), np.float32)
    latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-9)[:, None]
    counts = np.zeros((len(items.passages), len(idf)), np.uint8)
    for row, passage in zip(counts, items.passages):
        np.add.at(row, passage, 1)
    bits = _bits_of_terms(len(idf))
    return SimpleNamespace(
        idf=idf, weighted=_with_zeros(space * idf[:, None]), latent=latent, counts=counts, bits=bits,
        passage_bits=_narrow(_bits_of(bits, items.passages)), item_bits=_bits_of(bits, items.words),
    )


def _search(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(items.plain())
    table = materialise(numbered(docs, shared, id_col, text_col), "terms")
    texts = table.where("terms is not null").select("terms", "id")
    counted = table.where("seen is not null")
    n = counted.agg(F.sum("passages")).first()[0] or 0
    seen = np.zeros(len(items.terms))
    for r in counted.select(F.posexplode("seen").alias("term", "n")).groupBy("term").agg(F.sum("n").alias("n")).collect():
        seen[r["term"]] = r["n"]
    # words of answers alone are looked for later; they do not count in passages
    asked = np.isin(np.arange(len(seen)), np.concatenate(items.words))
    idf = (asked * (np.log((n + 1) / (seen + 1)) + 0.3)).astype(np.float32)
    space = latent_space(texts, idf)
    model = spark.sparkContext.broadcast(_model(items, idf, space))

    def search(batches):
        for batch, texts in _slices(batches):
            found = _matches(texts, shared.value, model.value)
            rows = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(rows), pa.array([shared.value.ids[f[1]] for f in found], pa.int64()),
                    *[pa.array([f[i] for f in found], kind) for i, kind in ((2, pa.float64()), (3, pa.float64()), (4, pa.int64()))],
                ],
                ["id", "item_id", "similarity", "cosine", "first_word"],
            )

    return texts.mapInArrow(search, f"id {id_type}, item_id long, similarity double, cosine double, first_word long")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None,
) -> DataFrame:
    """(id_col, item_id, similarity, cosine, first_word), a row for each document and item found in it.

    similarity is the share of the item's words in the longest common subsequence with the place found,
    first_word where that place begins. Without an answer column the item's last sentence is its answer.
    Null and empty texts contain nothing, items without words are found nowhere, and items with a null id
    take no part. Repeated rows of a document give one row. Other columns are ignored; with an empty
    table on either side the result is empty. Item ids are integers.
    """
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("bigint").alias("item"), F.col(item_text).alias("text"), answer.alias("answer")
    )
    held = items.agg(F.count("*").alias("n"), F.sum(F.size(F.split("text", " "))).alias("words")).first()
    n_blocks = max(1, -(-held["n"] // ITEMS_PER_BLOCK), -(-(held["words"] or 0) // WORDS_PER_BLOCK))
    found = None
    for b in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b).collect()
        block = Items([tuple(r) for r in rows])
        if block.ids:
            part = _search(docs, block, id_col, text_col)
            found = part if found is None else found.union(part)
    if found is None:
        id_type = docs.schema[id_col].dataType.simpleString()
        found = docs.sparkSession.createDataFrame([], f"id {id_type}, item_id long, similarity double, cosine double, first_word long")
    best = F.max(F.struct("similarity", "cosine", (-F.col("first_word")).alias("at"))).alias("best")
    return found.groupBy("id", "item_id").agg(best).select(
        F.col("id").alias(id_col), "item_id", "best.similarity", "best.cosine", (-F.col("best.at")).alias("first_word")
    )
