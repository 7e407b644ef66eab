"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every labelled text: each task adds up its own
counts per language and bucket, and only these sums are shuffled. The matrix of
log probabilities has one row per bucket and one column per language; at
`BUCKETS` rows its size is bounded by the number of languages, and more than
`LANGUAGES` of them are refused. It is broadcast, and a batch of texts is scored
by gathering the rows of its n-grams and adding them up per text.

A text that is null or has no letter is `und` with score 0; so is every text if
nothing could be learned. Equal scores go to the first language by name. Rows
with a null label are not learned from. Repeated rows count as often as they are there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

SIZES, BUCKETS, LANGUAGES = (1, 2, 3), 1 << 16, 1000
SMOOTHING, UNKNOWN = 0.5, "und"
_STEP = 1 << 16


def _codes(text: str) -> np.ndarray:
    """Code points in lower case, with every run of other characters than letters as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (codes >= 128) | ((codes >= 97) & (codes <= 122))
    codes = np.where(letter, codes, 32).astype(np.uint32)
    if len(codes) > 1:
        codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
    return codes


def ngrams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all n-grams of a text. `buckets` is a power of two."""
    codes = _codes(text).astype(np.uint64)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    found = []
    for size in SIZES:
        if len(codes) >= size:
            value = np.full(len(codes) - size + 1, size, np.uint64)
            for step in range(size):
                value = (value ^ codes[step : len(codes) - size + 1 + step]) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
            found.append(((value * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Sums per `lang` and `bucket` over `text`."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                sums.setdefault(lang, np.zeros(buckets, np.int64))
                sums[lang] += np.bincount(ngrams(text, buckets), minlength=buckets) if len(text) > 1000 else 0
                if len(text) <= 1000:
                    np.add.at(sums[lang], ngrams(text, buckets), 1)
        for lang, each in sums.items():
            used = np.flatnonzero(each)
            yield pd.DataFrame({"lang": lang, "bucket": used, "n": each[used]})

    labelled = docs.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    return labelled.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    )


def train(docs: DataFrame, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and their log probabilities per bucket.

    The languages are counted first, so that tasks and driver hold sums for `LANGUAGES` of them at most.
    """
    names = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang").distinct().limit(LANGUAGES + 1).count()
    if names > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages, for which the matrix is bounded")
    table = counts(docs, buckets).toPandas()
    langs = sorted(table["lang"].unique())
    sums = np.zeros((buckets, len(langs)))
    places = {lang: place for place, lang in enumerate(langs)}
    sums[table["bucket"].to_numpy(int), table["lang"].map(places).to_numpy(int)] = table["n"]
    return langs, np.log((sums + SMOOTHING) / (sums.sum(axis=0) + SMOOTHING * buckets)).astype(np.float32)


def score(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language of each text and its posterior probability, every language being as likely before."""
    sums = np.zeros((len(texts), len(langs)))
    judged = np.array([bool(langs) and isinstance(text, str) and any(map(str.isalpha, text)) for text in texts], bool)
    for place in np.flatnonzero(judged):
        found = ngrams(texts[place], len(matrix))
        for at in range(0, len(found), _STEP):
            sums[place] += matrix[found[at : at + _STEP]].sum(axis=0, dtype=np.float64)
    best = sums.argmax(axis=1) if langs else np.zeros(len(texts), int)
    odds = np.zeros(len(texts))
    if langs:
        odds = 1 / np.exp(np.clip(sums - sums.max(axis=1, keepdims=True), -700, 0)).sum(axis=1)
    names = [langs[one] if known else UNKNOWN for one, known in zip(best, judged)]
    return names, np.where(judged, odds, 0.0)


def predict(spark: SparkSession, docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """Add `lang_pred` and `score`, from `text` alone; columns of the input with these names are replaced."""
    shared = spark.sparkContext.broadcast(matrix)
    kind = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    @F.pandas_udf(kind)
    def judged(texts: pd.Series) -> pd.DataFrame:
        names, odds = score(list(texts), langs, shared.value)
        return pd.DataFrame({"lang_pred": names, "score": odds})

    own = F.struct(*[name for name in docs.columns if name not in ("lang_pred", "score")])
    return docs.select(own.alias("row"), judged("text").alias("judged")).select("row.*", "judged.*")
