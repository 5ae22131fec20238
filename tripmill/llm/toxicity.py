"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression."""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import crc_bucket, give_back, kept, key_bitmaps, materialised, slices, text_bytes, text_of, with_bit

#: Labelled rows the model is fitted on, at most. A larger set is sampled by the hash of its ids.
FIT_ROWS = 20_000

#: Entries of the lexicon, at most: the most telling ones stay. A feature of the classifier, sent to all tasks: under 1 MB.
LEXICON = 4_000

#: Toxic texts that must have an entry, and how sure an entry must be.
LEAST_TEXTS = 5
LEAST_SHARE = 0.7

#: Lengths of word beginnings that can be entries, beside whole words.
STEMS = (4, 5, 6)

#: Characters that stand for letters in disguised words.
DISGUISES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})

#: Words of the second person in the languages of the texts.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "usted ustedes ti tus vuestro vosotros os".split()
)

FEATURES = [
    "log_words",
    "word_hits",
    "word_density",
    "word_weight",
    "stem_hits",
    "stem_density",
    "stem_weight",
    "disguised_hits",
    "second_person_density",
    "hits_near_second_person",
    "capital_rate",
    "capital_word_rate",
    "exclamation_rate",
    "punctuation_rate",
    "digit_rate",
    "disguise_rate",
    "repeat_rate",
]

_WORD = re.compile(r"[^\W_]+")
#: Signs between letters of a token, or in front of its first one.
_SIGNS = re.compile(r"(?<=[^\W\d_])[\d@$!|*.\-_]+(?=[^\W\d_])|(?<!\w)[\d@$!|]+(?=[^\W\d_])")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_BEFORE, _AFTER = re.compile(r"\S*\Z"), re.compile(r"\S*")
_SQUEEZE = re.compile(r"(.)\1{2,}")
_EDGES = re.compile(r"^[^\w@$!|]+|\W+$")
_NO_LETTER = re.compile(r"[\W_]+")

#: Words whose weights a worker remembers. When full, it begins anew.
_REMEMBERED = 50_000

#: What a character is: other, letter, capital, digit or blank. Those beyond the first plane count as other.
_OTHER, _LETTER, _CAPITAL, _DIGIT, _BLANK = range(5)


def _kinds_of_characters() -> np.ndarray:
    kinds = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c.isupper():
            kinds[code] = _CAPITAL
        elif c.isalpha():
            kinds[code] = _LETTER
        elif c.isdigit():
            kinds[code] = _DIGIT
        elif c.isspace():
            kinds[code] = _BLANK
    return kinds


_KINDS = _kinds_of_characters()


def _token_around(text: str, start: int, end: int) -> str:
    """The token that holds the place, without signs at its edges; at most 60 characters to either side are looked at."""
    low = max(0, start - 60)
    head = _BEFORE.search(text[low:start]).group()
    tail = _AFTER.match(text[end : end + 60]).group()
    return _EDGES.sub("", head + text[start:end] + tail)


def disguised(text: str, triples: bool = True) -> list[str]:
    """Tokens with signs or digits among their letters, or a letter three times in a row, as plain words in lower case."""
    places = [m.span() for m in _SIGNS.finditer(text)]
    if triples:
        places += [m.span() for m in _TRIPLE.finditer(text)]
    found = []
    for token in {_token_around(text, *place) for place in places}:
        plain = _SQUEEZE.sub(r"\1", _NO_LETTER.sub("", token.lower().translate(DISGUISES)))
        if plain and plain != token.lower():
            found.append(plain)
    return found


def terms(text: str) -> set[str]:
    """The text's lexicon terms: different words, undisguised ones among them, and beginnings of words, marked by a star."""
    found = {*_WORD.findall(text.lower()), *disguised(text)}
    return found | {w[:n] + "*" for w in found for n in STEMS if len(w) > n}


#: Bytes of text whose terms a task counts at a time.
_TERM_BYTES = 4 << 20


class Lexicon:
    """How sure words and beginnings of words are to be toxic."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self._known: dict[str, tuple[float, float] | None] = {}

    def __getstate__(self):
        return self.weights

    def __setstate__(self, weights):
        self.__init__(weights)

    def weigh(self, word: str) -> tuple[float, float] | None:
        """Of the word, and of the surest of its beginnings; None where neither is in the lexicon."""
        try:
            return self._known[word]
        except KeyError:
            get = self.weights.get
            pair = get(word, 0.0), max(get(word[:n] + "*", 0.0) if len(word) > n else 0.0 for n in STEMS)
            if len(self._known) >= _REMEMBERED:
                self._known.clear()
            self._known[word] = known = pair if any(pair) else None
            return known


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of a whole text, in the order of ``FEATURES``."""
    words = _WORD.findall(text.lower())
    counts = Counter(words)
    n, chars = len(words) or 1, len(text) or 1
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _KINDS[np.where(code < 1 << 16, code, 0)]
    other, letters, capitals, digits, _ = np.bincount(kind, minlength=5).tolist()
    same = (code[2:] == code[1:-1]) & (code[1:-1] == code[:-2]) & ((kind[2:] == _LETTER) | (kind[2:] == _CAPITAL))
    triples = int(same.sum())
    upper = kind == _CAPITAL
    shouted = upper[2:] & upper[1:-1] & upper[:-2]
    shouted = int((shouted[1:] & ~shouted[:-1]).sum() + (len(shouted) > 0 and shouted[0]))
    hidden = disguised(text, triples > 0)
    hits, weight, stems, stem_weight, toxic = 0, 0.0, 0, 0.0, set()
    weigh = lexicon.weigh
    for word, count in counts.items():
        pair = weigh(word)
        if pair is not None:
            toxic.add(word)
            hits += count * (pair[0] > 0)
            stems += count * (pair[1] > 0)
            weight, stem_weight = max(weight, pair[0]), max(stem_weight, pair[1])
    second = sum(counts[w] for w in SECOND_PERSON & counts.keys())
    near = 0
    if toxic and second:
        last = -100
        for i, word in enumerate(words):
            if word in SECOND_PERSON:
                last = i
            if word in toxic and i - last <= 5:
                near += 1
    return [
        math.log1p(len(words)),
        float(hits),
        hits / n,
        weight,
        float(stems),
        stems / n,
        stem_weight,
        float(sum(1 for word in hidden if weigh(word))),
        second / n,
        float(near),
        capitals / ((letters + capitals) or 1),
        shouted / n,
        text.count("!") / chars,
        other / chars,
        digits / chars,
        len(hidden) / n,
        triples / chars,
    ]


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """Words and word beginnings that tell toxic texts, from rows (text, label): counted in Spark by number of texts."""

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic: dict[str, int] = {}
        clean: dict[str, int] = {}
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = toxic if label else clean
            for term in terms(text):
                counts[term] = counts.get(term, 0) + 1
        # A term that no toxic text of the slice has still counts as clean where another slice has it.
        keys = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.string()),
                pa.array([toxic.get(k, 0) for k in keys], pa.int64()),
                pa.array([clean.get(k, 0) for k in keys], pa.int64()),
            ],
            ["term", "toxic", "clean"],
        )

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column(0))
            for first, last in slices(offsets, _TERM_BYTES):
                yield counted(batch.slice(first, last - first))
        give_back()

    counts = labelled.select("text", "label").mapInArrow(exploded, "term string, toxic bigint, clean bigint")
    share = (F.col("toxic") / (F.col("toxic") + F.col("clean") + 1)).alias("share")
    found = (
        counts.groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_TEXTS)
        .select("term", "toxic", share)
        .where(F.col("share") >= LEAST_SHARE)
        .orderBy(F.desc(F.col("toxic") * F.col("share")), "term")
        .limit(LEXICON)
    )
    return Lexicon({r.term: r.share for r in found.toLocalIterator()})


def with_features(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Add ``features``, an array of doubles, to rows that have ``text``."""

    @F.arrow_udf("array<double>")
    def dense(texts: pa.Array) -> pa.Array:
        kept("toxicity", lambda: None)
        _, offsets = text_bytes(texts)
        kind = pa.list_(pa.float64())
        parts = [pa.array([], kind)]
        for first, last in slices(offsets):
            parts.append(pa.array([features(text, lexicon) for text in texts[first:last].to_pylist()], kind))
        return pa.concat_arrays(parts)

    return df.withColumn("features", dense("text"))


@dataclass
class ToxicityModel:
    """Lexicon, trees, and the steps of the calibration: raw scores and the probabilities there."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    raw: list[float]
    calibrated: list[float]
    prior: float

    def score(self, df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col, score, predicted`` of every row, by its whole text alone. An empty or null text is scored like any other."""
        # The id has a name of its own until the end, as it may be called like a column that is made here.
        rows = df.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text"))
        if self.trees is None:
            scored = rows.select("_id", F.lit(self.prior).alias("score"))
        else:
            scored = self._raw(with_features(rows, self.lexicon)).select("_id", self._calibration(F.col("raw")).alias("score"))
        return scored.select(F.col("_id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

    def _raw(self, df: DataFrame) -> DataFrame:
        vectors = df.withColumn("vector", array_to_vector("features")).drop("features", "text")
        return self.trees.transform(vectors).withColumn("raw", vector_to_array("_p")[1]).drop("vector", "_r", "_p", "_c")

    def _calibration(self, raw: Column) -> Column:
        """Linear between the steps, kept a little increasing so that equal probabilities still order."""
        xs, ys = self.raw, self.calibrated
        if not xs:
            return raw

        @F.pandas_udf("double")
        def line(values: pd.Series) -> pd.Series:
            at = np.interp(values, xs, ys)
            return pd.Series(np.clip(0.999 * at + 0.001 * values, 0.0, 1.0))

        return line(raw)


def fit_toxicity(
    df: DataFrame,
    labels: DataFrame,
    *,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> ToxicityModel:
    """Learn from the labelled rows for which ``usable`` (a condition on the id column) holds.

    The lexicon is counted in Spark over three eighths of all labelled rows, however many there are. The trees and the calibration use at
    most about ``fit_rows``: of more, those whose hashed id falls below the share that is wanted. A quarter of
    them is held back for isotonic calibration, where the trees, fitted on the rest, are compared with the labels.

    Rows without text, id or label teach nothing. An id labelled twice is toxic if any of its labels says so. With labels of one kind only, or none,
    the score is the share of toxic labels for all texts (0 if there are none). Other columns are not looked at.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    if usable is not None:
        known = labels.where(usable).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    total = known.count()
    share = 1_000_000 if total <= fit_rows else int(1_000_000 * fit_rows / total)
    back = F.pmod(F.xxhash64(F.lit("calibration"), "id"), F.lit(4)) == 0
    # The lexicon is learned on the part the trees are fitted on, but for half of it: on the texts it came from it would look surer than it is.
    half = F.pmod(F.xxhash64(F.lit("lexicon"), "id"), F.lit(2)) == 0
    known = known.withColumn("sampled", F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)
    # Texts that neither the lexicon nor the sample takes stay where they are.
    known = known.where(F.col("sampled") | (~back & half))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("id is not null and text is not null")
    # A bitmap of fixed size keeps the texts that no label is wanted of out of the join's shuffle.
    texts = with_bit(texts, key_bitmaps(known, ["id"]), ["id"], "wanted").where("wanted").drop("wanted")
    # Merged at any size: how many labels there are has no bound that a broadcast could rest on.
    rows = materialised(known.hint("merge").join(texts, "id"), "labelled")
    sampled = rows.where("sampled")
    sums = sampled.agg(F.count(F.lit(1)), F.sum("label"), F.count_if(back), F.sum(F.when(back, F.col("label")))).head()
    n, toxic, n_back, toxic_back = (x or 0 for x in sums)
    prior = toxic / n if n else 0.0
    if toxic in (0, n) or toxic - toxic_back in (0, n - n_back):
        return ToxicityModel(Lexicon({}), None, [], [], prior)
    lexicon = learn_lexicon(rows.where(~back & half))
    dense = materialised(with_features(sampled, lexicon).select("id", "label", "features", back.alias("back")), "features")
    fit = dense.where("not back").select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("vector"))
    trees = GBTClassifier(
        featuresCol="vector",
        labelCol="label",
        predictionCol="_c",
        maxIter=20,
        maxDepth=4,
        stepSize=0.3,
        maxBins=64,
        seed=7,
        cacheNodeIds=False,
    )
    trees = trees.setProbabilityCol("_p").setRawPredictionCol("_r").fit(fit)
    model = ToxicityModel(lexicon, trees, [], [], prior)
    raw = model._raw(dense.where("back")).select("raw", F.col("label").cast("double").alias("label"))
    model.raw, model.calibrated = _isotonic(raw)
    return model


def _isotonic(scored: DataFrame) -> tuple[list[float], list[float]]:
    from pyspark.ml.regression import IsotonicRegression

    fitted = IsotonicRegression(featuresCol="raw", labelCol="label").fit(scored)
    xs, ys = fitted.boundaries.toArray().tolist(), fitted.predictions.toArray().tolist()
    # One step for each score, so that the line between them is a function.
    steps = dict(zip(xs, ys, strict=True))
    return list(steps), list(steps.values())


def held_out(id_name: str = "doc_id") -> Column:
    """Whether the row is in the fifth of all rows that no model learns from."""
    return crc_bucket(id_name, 5) == 0
