"""Quality rules: how far a document's character classes and common words are from real languages.

Every document gets two histograms: of character classes, and of the common words of several
languages (all other words share one bin). The references are the sums of these histograms over
all documents of a language, so they follow the corpus. A document is kept if, for at least one
language, the Jensen-Shannon distance (base 2, so 0 to 1) to both references is small. Histograms
of very short texts say little, so each comparison has a minimum length; below it the comparison
is passed. Base rules on length and repetition come first.

Defined results: a null or empty text has no words and fails the base rules. Rows are judged one by
one, so ties and repeated rows get the same verdict. Languages without a reference (too few words,
or an empty table) are not compared with; with no reference at all only the base rules count. A
document's own ``lang``, null or not, has no part in its verdict. All other columns are kept, but for
those with the name of a result, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.support import extended, kept_columns, ship, small_batches
from millrace.llm.textcodes import SPACES, chunks, words
from millrace.storage import materialize

# Frequent words of four languages.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be at by this are from or an have not they which you were but his".split(),
    "fr": "de la le les et des en un une du que est pour qui dans par sur au pas plus avec ne ce se son il sont ou cette".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha".split(),
}
# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "point", "symbol", "other", "beyond_ascii")
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50
MIN_CLASS_CHARS = 200
MIN_WORD_COUNT = 100
MIN_REFERENCE_WORDS = 1000
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.31


def vocabulary() -> dict[bytes, int]:
    """All common words by bin; the last bin, not in here, is for every other word."""
    ordered = dict.fromkeys(w for group in COMMON_WORDS.values() for w in group)
    return {w.encode(): i for i, w in enumerate(ordered)}


def class_of_byte() -> np.ndarray:
    """Class of a character by its first byte; -1 for the later bytes of one character."""
    out = np.full(256, CLASSES.index("other"), np.int64)
    for kind, members in (
        ("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"),
        ("space", SPACES.decode()), ("point", ".,;:!?'\"()-"), ("symbol", SYMBOLS),
    ):
        out[list(members.encode())] = CLASSES.index(kind)
    out[0xC0:] = CLASSES.index("beyond_ascii")
    out[0x80:0xC0] = -1
    return out


def repeated_words(first: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a three-word window which the text has twice or more."""
    n, docs = len(codes), len(first) - 1
    out = np.zeros(docs, np.int64)
    if n < 3:
        return out
    doc = np.repeat(np.arange(docs), np.diff(first))
    inside = doc[:-2] == doc[2:]
    # Windows as pairs of codes of two-word windows, so that the numbers stay small.
    pair = np.unique(codes[:-1] * (codes.max() + 1) + codes[1:], return_inverse=True)[1]
    window = np.unique((pair[:-1] * (codes.max() + 1) + codes[2:]), return_inverse=True)[1]
    key = doc[:-2] * (window.max() + 1) + window
    key = key[inside]
    at = np.flatnonzero(inside)
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[count[where] > 1]
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[twice + k] = True
    return np.bincount(doc[covered], minlength=docs)


def repeated_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def features_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """Base counts and both histograms of each text."""
    parts = chunks(texts)
    found = words(parts)
    docs = len(texts)
    body, at, classes = parts.body, parts.at, class_of_byte()
    histogram = np.zeros((docs, 256), np.int64)
    lines = np.zeros(docs, np.int64)
    for d in range(docs):
        own = body[at[d] : at[d + 1]]
        histogram[d] = np.bincount(own, minlength=256)
        lines[d] = repeated_lines(own.tobytes())
    by_class = np.stack([histogram[:, classes == k].sum(1) for k in range(len(CLASSES))], 1)
    characters = histogram[:, classes >= 0].sum(1)
    common = vocabulary()
    bin_of = np.array([common.get(w, len(common)) for w in found.words], np.int64)
    doc = np.repeat(np.arange(docs), np.diff(found.first))
    bins = len(common) + 1
    by_word = np.bincount(doc * bins + bin_of[found.codes], minlength=docs * bins).reshape(docs, bins) if len(found.codes) else np.zeros((docs, bins), np.int64)
    return {
        "n_words": np.diff(found.first),
        "word_chars": characters - histogram[:, list(SPACES)].sum(1),
        "n_symbols": histogram[:, list(SYMBOLS.encode())].sum(1),
        "n_dup_lines": lines,
        "n_repeat_words": repeated_words(found.first, found.codes),
        "_classes": by_class,
        "_words": by_word,
    }


def as_column(values: np.ndarray) -> pa.Array:
    if values.ndim == 1:
        return pa.array(values, pa.int64())
    flat = pa.array(values.reshape(-1), pa.int64())
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), flat)


def _add_features(batches: Iterator[pa.RecordBatch], text_col: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_batches(whole, text_col):
            found = features_of(batch.column(text_col))
            columns = [batch.column(c) for c in keep] + [as_column(found[k]) for k in (*FEATURES, "_classes", "_words")]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *FEATURES, "_classes", "_words"])


def measured(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (all when not given), the base counts, and both histograms."""
    keep = kept_columns(df, keep, (*FEATURES, "_classes", "_words"))
    ship(df.sparkSession)
    added = ", ".join([*[f"{k} long" for k in FEATURES], "_classes array<long>, _words array<long>"])
    needed = df.select(*dict.fromkeys([*keep, text_col]))
    return needed.mapInArrow(partial(_add_features, text_col=text_col, keep=keep), extended(needed.select(*keep).schema, added))


def references(features: DataFrame, lang_col: str = "lang", min_words: int = MIN_REFERENCE_WORDS) -> dict[str, tuple[list[int], list[int]]]:
    """Summed histograms of all documents by language: one row for each of the known languages."""
    sizes = {"_classes": len(CLASSES), "_words": len(vocabulary()) + 1}
    sums = [F.sum(F.get(k, F.lit(i))).alias(f"{k}{i}") for k, n in sizes.items() for i in range(n)]
    known = features.filter(F.col(lang_col).isin(*COMMON_WORDS)).groupBy(lang_col).agg(*sums).collect()
    found = {r[lang_col]: tuple([r[f"{k}{i}"] for i in range(n)] for k, n in sizes.items()) for r in known}
    return {k: v for k, v in sorted(found.items()) if sum(v[1]) >= min_words}


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to one reference; 1 for a row of zeros."""
    total = counts.sum(1, keepdims=True)
    p = counts / np.maximum(total, 1)
    q = (reference / reference.sum())[None, :]
    m = (p + q) / 2

    def against(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(1)

    return np.where(total[:, 0] > 0, np.sqrt(np.maximum((against(p) + against(q)) / 2, 0)), 1.0)


def verdicts(features: dict[str, np.ndarray], refs: dict, limits: dict) -> dict[str, np.ndarray]:
    n_words = features["n_words"]
    failed = (n_words < limits["min_words"]) | (100 * features["n_repeat_words"] > 50 * n_words)
    nearest_class, nearest_word = np.full(len(n_words), np.nan), np.full(len(n_words), np.nan)
    good = np.full(len(n_words), not refs)
    short_class = features["_classes"].sum(1) < limits["min_class_chars"]
    short_word = n_words < limits["min_word_count"]
    for by_class, by_word in refs.values():
        of_class = distance(features["_classes"], np.array(by_class, float))
        of_word = distance(features["_words"], np.array(by_word, float))
        nearest_class, nearest_word = np.fmin(nearest_class, of_class), np.fmin(nearest_word, of_word)
        good |= (short_class | (of_class <= limits["max_class_distance"])) & (short_word | (of_word <= limits["max_word_distance"]))
    return {"class_distance": nearest_class, "word_distance": nearest_word, "base_failed": failed, "kept": ~failed & good}


def _judge(batches: Iterator[pa.RecordBatch], refs: dict, limits: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in FEATURES}
        for k, n in (("_classes", len(CLASSES)), ("_words", len(vocabulary()) + 1)):
            found[k] = batch.column(k).flatten().to_numpy().reshape(batch.num_rows, n)
        result = verdicts(found, refs, limits)
        rest = [c for c in batch.schema.names if c not in ("_classes", "_words")]
        columns = [batch.column(c) for c in rest] + [pa.array(v, from_pandas=True) for v in result.values()]
        yield pa.RecordBatch.from_arrays(columns, names=[*rest, *result])


def judge(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None,
    min_words: int = MIN_WORDS, min_class_chars: int = MIN_CLASS_CHARS, min_word_count: int = MIN_WORD_COUNT,
    max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """``keep`` columns of every row (all when not given) with counts, nearest distances and ``kept``.

    ``class_distance`` and ``word_distance`` are the smallest over the languages, null without any
    reference. ``base_failed`` comes from the base rules alone.
    """
    keep = kept_columns(df, keep, (*FEATURES, "_classes", "_words", "class_distance", "word_distance", "base_failed", "kept"))
    kept_for_reference = [*keep, *([] if lang_col in keep else [lang_col])]
    features = materialize(measured(df, text_col, kept_for_reference), "rule_features")
    refs = references(features, lang_col)
    limits = {
        "min_words": min_words, "min_class_chars": min_class_chars, "min_word_count": min_word_count,
        "max_class_distance": max_class_distance, "max_word_distance": max_word_distance,
    }
    narrow = features.select(*keep, *FEATURES, "_classes", "_words")
    schema = extended(narrow.drop("_classes", "_words").schema, "class_distance double, word_distance double, base_failed boolean, kept boolean")
    return narrow.mapInArrow(partial(_judge, refs=refs, limits=limits), schema)
