"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text.  The ordinary one is trained on
ordinary documents.  The toxic one holds the same content and, on top, what marks toxic
documents: stretches whose byte 5-grams are far more frequent in toxic than in ordinary
training documents (each context counted once, so copies don't count), in the words and
phrases they occur in.  (A dictionary trained on toxic text instead holds mostly what both
kinds of text share and tells them apart far worse; README has both figures.)  A text is cut into overlapping windows; each is compressed with both.  How much
shorter the toxic dictionary makes the windows is summed up in a few numbers per document,
and a logistic curve, fitted on training documents the dictionaries were not built from,
turns them into a score calibrated to the share of toxic labels.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.common import map_batches, shipped, text_strings

WINDOW, STRIDE = 64, 48
GRAM, CONTEXT = 5, 5
DICTIONARY = 64 << 10
LEVEL = 3
EXCESS, EVIDENCE = 8.0, 20.0  # least ratio of rates and least likelihood ratio (G) of a marking stretch
SAMPLE = 2000  # labelled rows of each class the model is fitted on, at most
SAMPLE_CHARS, SAMPLE_WINDOWS = 12_000, 12  # a longer sampled text is fitted on by windows spread evenly over it; all texts are scored, whole
SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


@dataclass
class Model:
    base: float = 0.0  # share of toxic labels, the score when nothing could be fitted
    ordinary: bytes = b""
    toxic: bytes = b""
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)


def lowered(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with gaps, the 5-gram at each place, and each place's text."""
    gap = b"\0" * (GRAM + 2 * CONTEXT)
    joined = np.frombuffer(gap + gap.join(texts) + gap, dtype=np.uint8)
    size = len(joined) - GRAM + 1
    codes = np.zeros(size, dtype=np.uint64)
    for i in range(GRAM - 1, -1, -1):
        codes <<= np.uint64(8)
        codes |= joined[i:i + size]
    lengths = np.array([len(gap), *(len(t) + len(gap) for t in texts)])
    owner = np.repeat(np.array([0, *range(len(texts))], dtype=np.int32), lengths)[:size]
    return joined, codes, owner


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 5-grams and in how many texts each occurs in a context not seen before.

    The driver's memory is bounded by some arrays of eight bytes a sampled character.
    """
    _, codes, owner = grams(texts)
    mid = slice(CONTEXT, len(codes) - CONTEXT)
    with np.errstate(over="ignore"):
        around = codes[:-2 * CONTEXT] * np.uint64(0x9E3779B97F4A7C15)
        around ^= codes[mid] * np.uint64(0xC2B2AE3D27D4EB4F)
        around ^= codes[2 * CONTEXT:] * np.uint64(0x165667B19E3779F9)
    order = np.argsort(around, kind="stable")
    around = around[order]
    first = order[np.concatenate([[True], around[1:] != around[:-1]])] if len(order) else order
    del around, order
    codes, owner = codes[mid][first], owner[mid][first]
    order = np.lexsort((owner, codes))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    return np.unique(codes[new], return_counts=True)


def evidence(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """Whether rates a/n_a exceed b/n_b by EXCESS with evidence EVIDENCE."""
    rate = (a + b) / (n_a + n_b)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(a > 0, a * np.log(a / (n_a * rate)), 0) + np.where(b > 0, b * np.log(b / (n_b * rate)), 0))
    return (a >= 3) & (g >= EVIDENCE) & ((a + 0.5) / (n_a + 1) >= EXCESS * (b + 0.5) / (n_b + 1))


def marking(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Stretches that mark toxic texts, most frequent first."""
    codes_a, counts_a = gram_counts(toxic)
    codes_b, counts_b = gram_counts(ordinary)
    at = np.searchsorted(codes_b, codes_a)
    there = (at < len(codes_b)) & (codes_b[np.minimum(at, len(codes_b) - 1)] == codes_a)
    b = np.where(there, counts_b[np.minimum(at, len(codes_b) - 1)], 0)
    good = evidence(counts_a.astype(float), b.astype(float), len(toxic), len(ordinary))
    codes_a, counts_a = codes_a[good], counts_a[good]
    if not len(codes_a):
        return []
    joined, codes, _ = grams(toxic)
    at = np.minimum(np.searchsorted(codes_a, codes), len(codes_a) - 1)
    weight = np.where(codes_a[at] == codes, counts_a[at], 0)
    places = np.flatnonzero(weight)
    runs = np.split(places, np.flatnonzero(np.diff(places) > 1) + 1)
    text = joined.tobytes()
    found: Counter[bytes] = Counter()
    for run in runs:
        strong = run[weight[run] * 2 >= weight[run].max()]  # the edges of a run are chance neighbours
        found[text[strong[0]:strong[-1] + GRAM]] += 1
    kept: list[bytes] = []
    for stretch, n in sorted(found.items(), key=lambda f: (-f[1], len(f[0]), f[0])):
        if n < 3:
            break
        if len(stretch) <= GRAM:
            continue
        a = np.array(float(sum(stretch in t for t in toxic)))
        b = np.array(float(sum(stretch in t for t in ordinary)))
        if evidence(a, b, len(toxic), len(ordinary)):
            kept.append(stretch)
    return kept


def word_forms(toxic: list[bytes], stretches: list[bytes]) -> list[bytes]:
    """The whole words or phrases that hold a marking stretch, most frequent first."""
    cores = sorted({b" ".join(s.split()) for s in stretches} - {b""})
    forms: Counter[bytes] = Counter()
    for text in set(toxic):
        flat, own = b" " + b" ".join(text.split()) + b" ", set()
        for core in cores:
            at = flat.find(core)
            while at >= 0:
                end = flat.index(b" ", at + len(core))
                own.add(flat[flat.rindex(b" ", 0, at) + 1:end].strip(b".,;:!?\"'()"))
                at = flat.find(core, end)
        forms.update(own)
    return [f for f, n in sorted(forms.items(), key=lambda f: (-f[1], f[0])) if n >= 2]


def compressors(model: Model):
    import zstandard
    return [zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        compression_params=zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False))
        for d in (model.ordinary, model.toxic)]


def features(texts: list[bytes], tools) -> np.ndarray:
    """What the windows of each whole text gain by the toxic dictionary, in seven numbers."""
    import zstandard
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    windows = np.where(sizes > 0, np.maximum(1, -(-(sizes - (WINDOW - STRIDE)) // STRIDE)), 0)
    total = int(windows.sum())
    out = np.zeros((len(texts), 7))
    if not total:
        return out
    owner = np.repeat(np.arange(len(texts)), windows)
    number = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.repeat(np.cumsum(sizes) - sizes, windows) + number * STRIDE
    lengths = np.minimum(WINDOW, sizes[owner] - number * STRIDE)
    cuts = np.stack([starts, lengths], axis=1).astype("<u8").tobytes()
    joined = zstandard.BufferWithSegments(b"".join(texts), cuts)
    ordinary, toxic = (np.fromiter((len(s) for s in tool.multi_compress_to_buffer(joined, threads=1)), np.int64, total)
                       for tool in tools)
    gain = (ordinary - toxic).astype(float)
    order = np.lexsort((-gain, owner))
    rank = number  # windows of a text are contiguous, so sorted ranks equal window numbers
    best = gain[order]
    some = np.maximum(windows, 1)
    for k, top in enumerate((1, 2, 4)):
        out[:, k] = np.bincount(owner, np.where(rank < top, best, 0), len(texts)) / np.minimum(some, top)
    out[:, 3] = np.bincount(owner, gain, len(texts)) / some
    out[:, 4] = np.bincount(owner, np.maximum(gain - 1, 0), len(texts)) / some
    out[:, 5] = np.bincount(owner, np.maximum(gain - 2, 0), len(texts)) / some
    out[:, 6] = np.log1p(sizes)
    return out


def fit(toxic: list[str], ordinary: list[str], base: float) -> Model:
    """The two dictionaries from two thirds of the texts, the curve from the other third."""
    import zstandard
    model = Model(base=base)
    a, b = [lowered(t) for t in toxic if t], [lowered(t) for t in ordinary if t]
    if not a or not b:
        return model
    few = min(len(a), len(b)) < 30  # then both parts are fitted on all
    build_a, build_b = (a, b) if few else ([t for i, t in enumerate(x) if i % 3 < 2] for x in (a, b))
    hold_a, hold_b = (a, b) if few else (a[2::3], b[2::3])
    try:
        model.ordinary = zstandard.train_dictionary(DICTIONARY, build_b).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        model.ordinary = b"\n".join(build_b)[-DICTIONARY:]
    forms = word_forms(build_a, marking(build_a, build_b))
    model.toxic = model.ordinary + b" " + b" ".join(reversed(forms)) + b" "
    tools = compressors(model)
    x = np.concatenate([features(hold_a, tools), features(hold_b, tools)])
    y = np.concatenate([np.ones(len(hold_a)), np.zeros(len(hold_b))])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    design = np.c_[(x - mean) / scale, np.ones(len(x))]
    weights = np.zeros(design.shape[1])
    pull = np.r_[np.full(len(weights) - 1, 0.5), 1e-6]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        weights += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(pull),
                                   design.T @ (y - p) - pull * weights)
    share = min(max(base, 1e-6), 1 - 1e-6)
    weights[-1] += math.log(share / (1 - share)) - math.log(len(hold_a) / len(hold_b))
    model.mean, model.scale, model.weights = mean.tolist(), scale.tolist(), weights.tolist()
    return model


def windows_of(text: Column) -> Column:
    """The text, or windows from its first to its last character if it is long."""
    each = SAMPLE_CHARS // SAMPLE_WINDOWS
    room = F.char_length(text) - each
    parts = [F.substring(text, (room * i / (SAMPLE_WINDOWS - 1)).cast("int") + 1, F.lit(each)) for i in range(SAMPLE_WINDOWS)]
    return F.when(F.char_length(text) > SAMPLE_CHARS, F.concat_ws("\n", *parts)).otherwise(text)


def train(docs: DataFrame, labels: DataFrame, training: Column | None = None, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows of each class, picked by a hash of ``doc_id``.

    One task fits the sample, whose size is bounded; the driver gets the model alone.
    ``training`` says which label rows may be used.  Null labels are left out; of several
    labels of a document the highest counts.
    """
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    if training is not None:
        marks = marks.where(training)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = marks.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
    pick = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    parts = []
    for toxic in (1, 0):
        ids = marks.where(F.col("toxic") > 0 if toxic else F.col("toxic") <= 0).orderBy(pick, "doc_id").limit(sample).select("doc_id")
        parts.append(docs.select("doc_id", windows_of(F.col("text")).alias("text")).where("text != ''")
                     .join(F.broadcast(ids), "doc_id", "left_semi")  # at most ``sample`` ids
                     .groupBy("doc_id").agg(F.min("text").alias("text")).select(F.lit(toxic).alias("toxic"), "doc_id", "text"))
    shipped(docs.sparkSession)

    def work(batches):
        import pyarrow as pa
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        model = fit([t for toxic, _, t in rows if toxic], [t for toxic, _, t in rows if not toxic], share)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = parts[0].unionByName(parts[1]).repartition(1).mapInArrow(work, "model binary").first()
    return pickle.loads(made["model"]) if made else fit([], [], share)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, score`` of every whole text.

    Null and empty texts have no window and get the score of a text that gains nothing;
    without labels of both classes every text gets the share of toxic labels.  Null keys
    and repeated rows are scored each; other columns are ignored.
    """
    def work(keys, texts):
        return {"doc_id": keys, "score": scored([lowered(t) for t in text_strings(texts)], model).tolist()}

    return map_batches(docs.select(docs[key].cast("long"), docs[text].cast("string")), work, SCORED)


def scored(texts: list[bytes], model: Model) -> np.ndarray:
    if not model.weights:
        return np.full(len(texts), model.base)
    out = np.zeros(len(texts))
    tools = compressors(model)
    at = 0
    while at < len(texts):  # some MB at a time
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= 8 << 20):
            size += len(texts[end])
            end += 1
        x = (features(texts[at:end], tools) - np.array(model.mean)) / np.array(model.scale)
        z = x @ np.array(model.weights[:-1]) + model.weights[-1]
        out[at:end] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        at = end
    return out


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that score under ``least``; columns as before.

    Null and empty texts, repeated rows and missing labels as in ``train`` and ``score``; an empty
    table gives no rows; other columns may have any name.
    """
    model = train(docs, labels)
    schema = docs.schema
    shipped(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = [lowered(t) for t in text_strings(batch.column(batch.schema.get_field_index("text")))]
            yield batch.filter(pa.array(scored(texts, model) < least))

    return docs.mapInArrow(run, schema)
