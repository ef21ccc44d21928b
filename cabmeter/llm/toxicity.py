"""Toxicity by a small convolutional text classifier, trained with numpy.

A word's embedding is the mean of hashed embeddings of the word and of its
beginnings and endings, so unseen forms of a known stem have one too.
Filters over one, two and three words, the maximum over the text, a logistic
layer.  Every word of a text is read; a score does not depend on language,
source or id.  Thresholds are set for each language on labelled rows that
the training left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.llm.textops import byte_values, lower_ascii, prefix_sums, row_chunks, scramble, span_hash, utf8, word_spans

BUCKETS = 1 << 16
DIMS = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
PARTS = ((0, 0), (3, 0), (4, 0), (5, 0), (0, 3), (0, 4))  # bytes of a beginning or ending; 0, 0: the word
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


@dataclass
class Model:
    """What scoring needs: a few megabytes whatever the corpus."""

    embedding: np.ndarray  # buckets x dims
    filters: list[np.ndarray]  # per width: width x dims x filters
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    scale: tuple[float, float]  # slope and shift of the calibrated logit
    thresholds: dict[str, float]
    threshold: float


def word_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and buckets of its parts (words x parts)."""
    sums = prefix_sums(byte_values()[data])
    out = np.empty((len(starts), len(PARTS)), np.int64)
    for k, (head, tail) in enumerate(PARTS):
        lo = np.maximum(starts, ends - tail) if tail else starts
        hi = np.minimum(ends, starts + head) if head else ends
        out[:, k] = scramble(span_hash(sums, lo, hi), 41 + k) & np.uint64(BUCKETS - 1)
    return scramble(span_hash(sums, starts, ends), 40), out


def read_words(column):
    """Chunks of an Arrow text column: first row, last row, for each distinct
    word its buckets, for each place its word, and rows' first places."""
    data, offsets = utf8(column)
    for lo, hi in row_chunks(offsets):
        part = lower_ascii(data[offsets[lo]: offsets[hi]])
        starts, ends, first = word_spans(part, offsets[lo: hi + 1] - offsets[lo], SEPARATORS)
        if not len(starts):
            yield lo, hi, np.zeros((0, len(PARTS)), np.int64), np.zeros(0, np.int64), first
            continue
        names, buckets = word_buckets(part, starts, ends)
        _, at, place = np.unique(names, return_index=True, return_inverse=True)
        yield lo, hi, buckets[at], place, first


def _padded(place: np.ndarray, first: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with blanks after each row, where rows start, and a mask of the
    places where a filter may start: each word, or a blank of an empty row."""
    pad = max(WIDTHS) - 1
    counts = np.diff(first)
    starts = np.concatenate(([0], np.cumsum(counts + pad)))
    out = np.full(starts[-1], blank, np.int64)
    out[np.arange(len(place)) + pad * np.repeat(np.arange(len(counts)), counts)] = place
    inside = np.arange(starts[-1]) - np.repeat(starts[:-1], counts + pad) < np.repeat(np.maximum(counts, 1), counts + pad)
    return out, starts[:-1], inside


def _activations(vectors: np.ndarray, places: np.ndarray, filters: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """What each filter makes of the words from every place on."""
    width, n = len(filters), len(places)
    out = np.broadcast_to(bias, (n, len(bias))).copy()
    for j in range(width):
        out[: n - j] += (vectors @ filters[j])[places[j:]]
    return out


def raw_scores(model: Model, column) -> np.ndarray:
    """Logits of the texts of an Arrow column."""
    out = np.zeros(len(column))
    for lo, hi, buckets, place, first in read_words(column):
        vectors = np.zeros((len(buckets) + 1, DIMS), np.float32)
        vectors[:-1] = model.embedding[buckets].mean(axis=1)
        places, starts, inside = _padded(place, first, len(buckets))
        features = []
        for filters, bias in zip(model.filters, model.biases):
            z = _activations(vectors, places, filters, bias)
            z[~inside] = -np.inf
            features.append(np.maximum(np.maximum.reduceat(z, starts, axis=0), 0))
        out[lo:hi] = np.concatenate(features, axis=1) @ model.weights + model.bias
    return out


def probability(model: Model, logits: np.ndarray) -> np.ndarray:
    slope, shift = model.scale
    return 1 / (1 + np.exp(-np.clip(slope * logits + shift, -40, 40)))


def _log_odds(buckets: list[np.ndarray], labels: np.ndarray, smooth: float = 3.0) -> np.ndarray:
    """How much likelier a bucket is in a text labelled 1, by how many texts
    of either label have it; near 0 for buckets that few texts have."""
    counts = np.zeros((2, BUCKETS))
    for row, y in zip(buckets, labels):
        counts[int(y), np.unique(row)] += 1
    n = np.maximum(np.bincount(labels.astype(int), minlength=2), 1)
    base = n[1] / n.sum()
    total = counts.sum(axis=0)
    odds = (counts[1] + smooth * base) / (counts[0] + smooth * (1 - base))
    return (np.log(odds) - np.log(base / (1 - base))) * (total > 0) if 0 < base < 1 else np.zeros(BUCKETS)


def train(texts, labels: np.ndarray, langs: list, seed: int = 5, steps: int = 400, batch: int = 64, rate: float = 0.05) -> Model:
    """A classifier of Arrow texts with 0/1 labels.

    One row in five is left out to scale the scores and to set a threshold
    for each language; with labels of one kind only, scores are constant.
    The rows are gone through until ``steps`` batches are done."""
    rng = np.random.default_rng(seed)
    documents = []
    for lo, hi, buckets, place, first in read_words(texts):
        small = buckets.astype(np.uint16)
        documents += [small[place[first[i]: first[i + 1]]] for i in range(hi - lo)]
    labels = np.asarray(labels, np.float64)
    order = rng.permutation(len(labels))
    held, fit = order[: len(order) // 5], order[len(order) // 5:]
    embedding = rng.normal(0, 0.05, (BUCKETS, DIMS)).astype(np.float32)
    embedding[:, 0] = np.clip(_log_odds([documents[i] for i in fit], labels[fit]), -4, 6)
    filters = [rng.normal(0, 0.1, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0, : FILTERS // 2] = 1.0  # half of the filters begin at the likelier words
    biases = [np.full(FILTERS, -0.5, np.float32) for _ in WIDTHS]
    weights, bias = rng.uniform(0, 0.3, FILTERS * len(WIDTHS)), -1.0
    squares: dict[str, np.ndarray] = {}

    def descend(name, value, gradient, at=None):
        """One step of Adagrad."""
        total = squares.setdefault(name, np.full(np.shape(value), 1e-2))
        if at is None:
            total += gradient**2
            return value - rate * gradient / np.sqrt(total)
        np.add.at(total, at, gradient**2)
        np.add.at(value, at, -rate * gradient / np.sqrt(total[at]))
        return value

    share = labels[fit].mean() if len(fit) else 0
    both = 0 < share < 1
    for _ in range(-(-steps // -(-len(fit) // batch)) if both else 0):
        for lo in range(0, len(fit), batch):
            rows = fit[lo: lo + batch]
            own = [documents[i] for i in rows]
            first = np.concatenate(([0], np.cumsum([len(d) for d in own])))
            places, starts, inside = _padded(np.arange(first[-1]), first, first[-1])
            buckets = np.concatenate([*own, np.zeros((1, len(PARTS)), np.uint16)])
            vectors = embedding[buckets].mean(axis=1)
            vectors[-1] = 0
            best, features = [], []
            for f, b in zip(filters, biases):
                z = _activations(vectors, places, f, b)
                z[~inside] = -np.inf
                stops = np.append(starts[1:], len(places))
                top = np.stack([s + z[s:e].argmax(axis=0) for s, e in zip(starts, stops)])
                best.append(top)
                features.append(np.maximum(np.take_along_axis(z, top, axis=0), 0))
            x = np.concatenate(features, axis=1)
            y = labels[rows]
            p = 1 / (1 + np.exp(-np.clip(x @ weights + bias, -40, 40)))
            error = (p - y) * np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(rows)
            back = error[:, None] * weights[None, :] * (x > 0)
            weights = descend("weights", weights, x.T @ error)
            bias = float(descend("bias", np.array(bias), error.sum()))
            touched, moves = [], []
            for k, (f, top) in enumerate(zip(filters, best)):
                g = back[:, k * FILTERS: (k + 1) * FILTERS]
                slope = np.zeros_like(f)
                for j in range(len(f)):
                    at = np.minimum(top + j, len(places) - 1)
                    word = places[at]
                    slope[j] = (vectors[word] * g[:, :, None]).sum(axis=0).T
                    live = (g != 0) & (word < first[-1])
                    touched.append(word[live])
                    moves.append((g[:, :, None] * f[j].T[None, :, :])[live])
                filters[k] = descend(f"filter {k}", f, slope).astype(np.float32)
                biases[k] = descend(f"bias {k}", biases[k], g.sum(axis=0)).astype(np.float32)
            words = np.concatenate(touched)
            if len(words):
                move = np.concatenate(moves) / len(PARTS)
                descend("embedding", embedding, np.repeat(move, len(PARTS), axis=0), buckets[words].ravel())
        fit = rng.permutation(fit)

    model = Model(embedding, filters, biases, weights, float(bias), (1.0, 0.0), {}, 0.5)
    if both and len(held):
        logits = raw_scores(model, texts.take(_indices(held)))
        model.scale = _scale(logits, labels[held])
        scores = probability(model, logits)
        model.threshold = _threshold(scores, labels[held], 0.5)
        names = np.array([str(langs[i]) for i in held])
        model.thresholds = {lang: _threshold(scores[names == lang], labels[held][names == lang], model.threshold) for lang in sorted(set(names.tolist()))}
    elif not both:
        model.weights, model.bias = np.zeros_like(weights), 2.0 if share else -2.0
    return model


def _indices(at: np.ndarray):
    import pyarrow as pa

    return pa.array(at)


def _scale(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make logits into probabilities (Platt), with a
    weak pull to the plain logit."""
    slope, shift = 1.0, 0.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(slope * logits + shift, -40, 40)))
        e = (p - labels) / len(labels)
        slope -= 0.2 * ((e * logits).sum() + 1e-3 * (slope - 1))
        shift -= 0.2 * (e.sum() + 1e-3 * shift)
    return (max(float(slope), 0.1), float(shift))


def _threshold(scores: np.ndarray, labels: np.ndarray, default: float, least: int = 5) -> float:
    """Where F1 is best, in the middle of the gap; the default for fewer
    than ``least`` rows of either label."""
    if (labels == 1).sum() < least or (labels == 0).sum() < least:
        return default
    order = np.argsort(-scores)
    hit = np.cumsum(labels[order])
    f1 = 2 * hit / (np.arange(1, len(order) + 1) + labels.sum())
    last = int(f1.argmax())
    below = scores[order[last + 1]] if last + 1 < len(order) else 0.0
    return float((scores[order[last]] + below) / 2)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def training_rows(docs: DataFrame, labels: DataFrame, positives: int, negatives: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most so many labelled rows of either label, chosen by a hash of
    their id, never of those held out."""
    label = F.col("toxic").cast("int")
    usable = (labels.where(F.col(id_col).isNotNull() & label.isin(0, 1)).groupBy(id_col).agg(F.max(label).alias("toxic"))
              .where(F.coalesce(remainder(F.col(id_col)) != 2, F.lit(False))))
    order = F.xxhash64(F.col(id_col), F.lit(11))
    chosen = (usable.where("toxic = 1").orderBy(order, id_col).limit(positives)
              .unionByName(usable.where("toxic = 0").orderBy(order, id_col).limit(negatives)))
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    return (docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), lang.alias("lang"))
            .join(F.broadcast(chosen), id_col).select(id_col, "text", "lang", "toxic"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, positives: int = 3000, negatives: int = 6000,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model fitted on a bounded sample of labelled rows: at most
    ``positives`` rows with label 1 and ``negatives`` with label 0, of rows
    whose crc32(id) modulo 4 is not 2.  Rows whose id repeats take label 1 if
    any has it; null labels and ids are left out."""
    rows = training_rows(docs, labels, positives, negatives, id_col, text_col, lang_col)

    def fit(table):
        import pickle

        import pyarrow as pa

        table = table.select(["name", "text", "lang", "toxic"]).sort_by([("name", "ascending"), ("text", "ascending")])
        model = train(table["text"].combine_chunks(), np.asarray(table["toxic"], np.float64), table["lang"].to_pylist())
        return pa.table({"model": pa.array([pickle.dumps(vars(model))], pa.binary())})

    # One task trains: the sample is bounded, and the driver never sees its texts.
    fitted = (rows.select(F.lit(1).alias("all"), F.col(id_col).cast("string").alias("name"), "text", "lang", "toxic")
              .groupBy("all").applyInArrow(fit, "model binary").collect())
    if not fitted:
        return train(_empty_texts(), np.zeros(0), [])
    import pickle

    return Model(**pickle.loads(fitted[0].model))


def _empty_texts():
    import pyarrow as pa

    return pa.array([], pa.string())


def score_toxicity(df: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang",
                   score_col: str = "score", reject_col: str = "rejected") -> DataFrame:
    """``df`` with ``score_col`` (0 to 1, higher: label 1 likelier) and
    ``reject_col`` (the score reaches the threshold of the row's language, or
    the general one if the language is null or unknown).

    The score is of the whole text alone.  Null and blank texts are scored as
    texts without words.  Columns with the names of the new ones are
    replaced; all others stay.  An empty table gives an empty result.
    """
    # Plain arrays and numbers: executors need not be able to import this package to read them.
    shared = df.sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("double")
    def score(texts):
        import pyarrow as pa

        model = Model(**shared.value)
        return pa.array(probability(model, raw_scores(model, texts)))

    limits = F.create_map(*(x for k, v in sorted(model.thresholds.items()) for x in (F.lit(k), F.lit(v)))) if model.thresholds else None
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in df.columns else F.lit("")
    limit = F.coalesce(F.try_element_at(limits, lang), F.lit(model.threshold)) if limits is not None else F.lit(model.threshold)
    return df.withColumn(score_col, score(F.col(text_col).cast("string"))).withColumn(reject_col, F.col(score_col) >= limit)
