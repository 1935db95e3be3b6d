"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1; each bit has a binary classifier over hashed byte n-grams
that says on which side of it a text is. A text gets the language whose codeword is nearest to the
classifiers' answers: the loss of every bit counts by how well its classifier told that language's own
training texts. A text whose two nearest codewords are about as near is flagged as ambiguous.

The classifiers are fitted on a bounded sample, at most about `rows_per_language` texts of each
language; whole texts are read, in fitting and in prediction.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.tables import id_and_text, in_slices

BITS = 11  # of a hashed feature
ORDERS = (1, 2, 3, 4)
PIECE = 1 << 20  # bytes of a text that are counted at a time
MIXER = np.uint32(2654435761)  # Fibonacci hashing
LETTER = regex.compile(r"\p{L}")
# Capitals as small letters, other ASCII as spaces; bytes of other scripts as they are.
FOLD = bytes(ord(chr(b).lower()) if chr(b).isalpha() and b < 128 else b if b >= 128 else 32 for b in range(256))


def features(raw: bytes) -> np.ndarray:
    """Square roots of hashed n-gram counts, of length 1."""
    counts = np.zeros(1 << BITS)
    text = raw.translate(FOLD)
    for at in range(0, len(text), PIECE):
        window = np.frombuffer(text, np.uint8, min(PIECE + max(ORDERS) - 1, len(text) - at), at).astype(np.uint32)
        for n in ORDERS:
            own = min(PIECE, len(window) - n + 1)  # n-grams that begin in this piece
            if own <= 0:
                continue
            code = np.full(own, n, np.uint32)
            for i in range(n):
                code = code * np.uint32(257) + window[i : i + own]
            code = (code ^ (code >> np.uint32(15))) * MIXER
            counts += np.bincount(code >> np.uint32(32 - BITS), minlength=1 << BITS)
    vector = np.sqrt(counts)
    return (vector / max(1.0, np.linalg.norm(vector))).astype(np.float32)


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """A row of +1 and -1 for each class: all ways to part them for few, else random ones far apart."""
    if n <= 6:
        others = range(1, n)
        sides = [set(c) for k in range(1, n) for c in combinations(others, k)] or [set()]
        return np.array([[-1.0 if i in side else 1.0 for side in sides] for i in range(n)])
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(100):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        nearest = min(np.sum(code[i] != code[j]) for i in range(n) for j in range(i))
        if nearest > apart:
            best, apart = code, nearest
    return best


class Model:
    """Languages, codewords, classifiers (with a bias), and the weight of each bit for each language."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray) -> None:
        self.languages, self.code, self.weights, self.trust = languages, code, weights, trust

    def losses(self, vectors: np.ndarray) -> np.ndarray:
        margins = np.hstack([vectors, np.ones((len(vectors), 1), vectors.dtype)]) @ self.weights
        each = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        return (each * self.trust[None]).sum(2)


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 500, rounds: int = 200
) -> Model | None:
    """A model of the languages of labelled, or None where no row has both a language and a letter.

    At most about rows_per_language whole texts of each language come to the driver, as hashed features.
    """
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    sample = usable.sampleBy(F.col(lang_col), {k: min(1.0, rows_per_language / n) for k, n in sizes.items()}, seed=1)

    def featurise(batches):
        for batch in in_slices(batches):
            langs, vectors = [], []
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # the text, and a few words out of its middle: what short texts look like
                middle = raw[len(raw) // 2 : len(raw) // 2 + 20 + len(raw) % 100]
                for part in (raw, middle):
                    langs.append(lang)
                    vectors.append(features(part).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(vectors, pa.binary())], ["lang", "x"])

    made = id_and_text(sample.withColumn(lang_col, F.col(lang_col).cast("string")), lang_col, text_col)
    rows = made.mapInArrow(featurise, "lang string, x binary").collect()
    if not rows:
        return None
    at = {k: i for i, k in enumerate(languages)}
    kind = np.array([at[r["lang"]] for r in rows])
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    code = codewords(len(languages)).astype(np.float32)
    y = code[kind]
    each = (1 / np.bincount(kind, minlength=len(languages)))[kind, None].astype(np.float32) / len(languages)
    w, step = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros((x.shape[1], y.shape[1]), np.float32)
    for _ in range(rounds):  # logistic regression by gradient descent with momentum
        margins = y * (x @ (w + 0.9 * step))
        slope = x.T @ (-y * each / (1 + np.exp(margins))) + 1e-6 * w
        step = 0.9 * step - 4.0 * slope
        w = w + step
    right = (y * (x @ w) > 0).astype(float)
    told = np.array([right[kind == i].mean(0) if (kind == i).any() else np.ones(y.shape[1]) for i in range(len(languages))])
    trust = np.maximum(told, 1e-3)
    return Model(languages, code, w, trust / trust.sum(1, keepdims=True) * y.shape[1])


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text", least_margin: float = 0.05) -> DataFrame:
    """docs with lang_pred, score and ambiguous, as identify() gives them; columns of these names are replaced."""
    # plain values, which tasks can read where this package is not installed
    parts = None if model is None else (model.languages, model.code, model.weights, model.trust)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model, n = Model(*shared.value) if shared.value else None, len(texts)
        lang, score, close = ["und"] * n, [0.0] * n, [False] * n
        for at in range(0, n, 256):
            rows = [i for i in range(at, min(n, at + 256)) if model and LETTER.search(texts.iat[i] or "")]
            if not rows:
                continue
            loss = model.losses(np.stack([features(texts.iat[i].encode()) for i in rows]))
            share = np.exp(loss.min(1, keepdims=True) - loss)
            share /= share.sum(1, keepdims=True)
            best, ranked = loss.argmin(1), np.sort(loss, axis=1)
            for k, i in enumerate(rows):
                lang[i], score[i] = model.languages[best[k]], float(min(1.0, share[k, best[k]]))
                close[i] = len(model.languages) > 1 and bool(ranked[k, 1] - ranked[k, 0] < least_margin)
        return pd.DataFrame({"lang_pred": lang, "score": score, "ambiguous": close})

    kept = docs.drop("lang_pred", "score", "ambiguous").withColumn("_said", predict(F.coalesce(F.col(text_col), F.lit(""))))
    return kept.select(*[c for c in kept.columns if c != "_said"], "_said.*")


def identify(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", least_margin: float = 0.05
) -> DataFrame:
    """(id_col, lang_pred, score, ambiguous) for each row of docs.

    lang_pred is `und`, with score 0, where the text is null, empty or has no letter, or the model is
    None. score is the share of the nearest codeword among exp(-loss); ambiguous says that the second is
    nearer than least_margin to it. Ids may be null or repeated; only the text decides, other columns are
    ignored.
    """
    said = with_language(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, "text", least_margin)
    return said.select(F.col("id").alias(id_col), "lang_pred", "score", "ambiguous")
