"""Quality rules in DataFrame expressions: base counts, and divergence from language references.

Base counts come from the words (runs between white space) and lines of the whole text. The method
compares two histograms of a document with those of its language by Jensen-Shannon distance (base
2, so 0 to 1): its character classes and its shares of common words. A language's reference is the
sum of the histograms of all its documents that have ``MIN_WORDS`` words and pass the base rules
that need no second look (too short); it is computed from the table itself. A guard of minimum
lengths keeps short documents from being judged by a distance. Documents of other or unknown
languages have no reference and are judged by the base rules alone.

Null and empty texts have no words and fail the base rule of 20 words. Rows are independent apart
from the references, so repeated rows get the same verdict; an empty table gives no rows; other
columns, whatever their names, are ignored by ``assess`` and kept by ``keep_good``. Very long texts
are judged whole, in one row of a task. Everything runs in the JVM; the only
shuffle sums one row of counts per task and language, and the references, one row for each of the
languages of ``COMMON_WORDS``, are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.tables import plain_names, small_batches
from pickwise.workspace import materialize

#: Fewest words of a document that is kept, and of one that is judged by character classes.
LEAST_WORDS, MIN_WORDS = 20, 50
#: Fewest words of a document that is judged by its common words.
MIN_WORDS_COMMON = 100
#: Largest share of words in repeated windows, in percent.
MOST_REPEATED = 30
#: Words in a window that counts as repeated.
WINDOW = 8
#: Largest distances of a kept document, set on labelled rows: they part nearly all good ones from
#: texts strewn with symbols and from bare word lists.
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.24

# The commonest words by language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "das", "in", "von", "zu", "mit", "ist", "den"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "was"],
    "es": ["de", "la", "que", "el", "en", "los", "se", "del", "las", "un"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "que", "dans"],
}
_COMMON = 10
_SPACE = "[ \\t-\\r]+"
_CLASSES = ["upper", "digit", "punctuation", "symbol", "space", "rest"]


def _counted(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the histograms; the text and words stay as ``__text`` and ``__words``."""
    split = docs.select(
        *keep, F.col("lang").alias("__lang"), F.coalesce("text", F.lit("")).alias("__text")
    ).withColumn("__words", F.array_remove(F.split("__text", _SPACE), ""))
    every = sorted({word for words in COMMON_WORDS.values() for word in words})
    listed = ", ".join(f"'{word}'" for word in every)
    # Most characters are small letters and spaces: without them the other classes are found fast.
    narrowed = split.withColumns(
        {
            "__few": F.regexp_replace("__text", "[a-z\\s]+", ""),
            "__frequent": F.expr(f"filter(__words, x -> x in ({listed}))"),
            "__n_words": F.size("__words").cast("long"),
            "__n_chars": F.length("__text").cast("long"),
            "__word_chars": F.length(F.array_join("__words", "")).cast("long"),
        }
    )
    count = lambda pattern: F.regexp_count("__few", F.lit(pattern)).cast("long")
    names = F.create_map(
        *[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    )
    common = names[F.col("__lang")]
    counts = {
        "__upper": count("\\p{Lu}"),
        "__digit": count("[0-9]"),
        "__punctuation": count("[.,;:!?'\"()-]"),
        "__symbol": count("[#*$%&|<>]"),
        "__space": F.col("__n_chars") - F.col("__word_chars"),
    }
    for n in range(_COMMON):
        left = F.size(F.array_remove("__frequent", common[n]))
        counts[f"__common_{n}"] = (F.size("__frequent") - left).cast("long")
    counted = narrowed.withColumns(counts)
    seen = sum((F.col(f"__common_{n}") for n in range(1, _COMMON)), F.col("__common_0"))
    classed = sum((F.col(f"__{k}") for k in _CLASSES[1:5]), F.col("__upper"))
    return counted.withColumns(
        {"__rest": F.col("__n_chars") - classed, "__other": F.col("__n_words") - seen}
    ).drop("__few", "__frequent")


_GROUPS = {
    "classes": [f"__{k}" for k in _CLASSES],
    "commons": [*[f"__common_{n}" for n in range(_COMMON)], "__other"],
}


def references(counted: DataFrame) -> DataFrame:
    """Language and its two histograms, at most one row per language of ``COMMON_WORDS``."""
    known = counted.filter(
        F.col("__lang").isin(*COMMON_WORDS) & (F.col("__n_words") >= MIN_WORDS)
    )
    sums = [F.sum(c).alias(c) for group in _GROUPS.values() for c in group]
    return known.groupBy(F.col("__lang").alias("__ref_lang")).agg(*sums).select(
        "__ref_lang", *[F.array(*group).alias(f"__ref_{k}") for k, group in _GROUPS.items()]
    )


def distance(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance of two arrays of counts; 0 if one of them is empty."""
    total = lambda a: f"aggregate({a}, 0L, (n, x) -> n + x)"
    part = "if({0} > 0, {0} * log2(2 * {0} / (p + q)), 0D)"
    terms = (
        f"zip_with(transform({counts}, x -> x / {total(counts)}), "
        f"transform({reference}, x -> x / {total(reference)}), (p, q) -> {part.format('p')} + {part.format('q')})"
    )
    summed = f"aggregate({terms}, 0D, (n, x) -> n + x)"
    return F.expr(
        f"if({total(counts)} > 0 and {total(reference)} > 0, sqrt(greatest({summed}, 0D) / 2), 0D)"
    )


def _repeats(docs: DataFrame) -> DataFrame:
    """Adds ``__repeated``, the number of words in windows found twice or more in the text.

    Windows are found by a 64-bit hash each, made by pairing hashes of half their length, and
    confirmed word by word.
    """
    hashed = docs.withColumn("__hashes", F.expr("transform(__words, x -> xxhash64(x))"))
    for half in (1, 2, 4):
        later = f"slice(__hashes, {half + 1}, size(__hashes))"
        pairs = f"zip_with(slice(__hashes, 1, greatest(size(__hashes) - {half}, 0)), {later}, (a, b) -> xxhash64(a, b))"
        hashed = hashed.withColumn("__hashes", F.expr(pairs))
    twice = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    ordered = hashed.withColumn(
        "__ordered",
        F.when(twice, F.expr("sort_array(transform(__hashes, (h, i) -> struct(h as h, i as i)))")),
    )
    same = (
        "(get(__ordered, {0}).h = e.h and slice(__words, get(__ordered, {0}).i + 1, {1}) = "
        "slice(__words, e.i + 1, {1}))"
    )
    found = ordered.withColumn(
        "__found",
        F.expr(
            "sort_array(transform(filter(__ordered, (e, k) -> coalesce("
            f"{same.format('k - 1', WINDOW)}, false) or coalesce({same.format('k + 1', WINDOW)}, false)), "
            "e -> e.i))"
        ),
    )
    covered = (
        f"aggregate(transform(__found, (x, k) -> least({WINDOW}, coalesce(get(__found, k + 1) - x, {WINDOW}))), "
        "0L, (n, x) -> n + x)"
    )
    return found.withColumn("__repeated", F.coalesce(F.expr(covered), F.lit(0)).cast("long")).drop(
        "__hashes", "__ordered", "__found"
    )


def _features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the language and every count of a row."""
    lines = "filter(split(__text, '\\n'), x -> x rlike '[^ \\\\t-\\\\r]')"
    counted = _repeats(_counted(docs, keep)).withColumn("__lines", F.expr(lines))
    duplicates = F.size("__lines") - F.size(F.array_distinct("__lines"))
    return counted.withColumn("__dup_lines", duplicates.cast("long")).drop(
        "__lines", "__words", "__text"
    )


def _judged(features: DataFrame, reference: DataFrame) -> DataFrame:
    """``features`` with the distances and the verdicts."""
    joined = features.join(
        F.broadcast(reference), F.col("__lang") == F.col("__ref_lang"), "left"
    )
    far = joined.withColumns(
        {
            "__class_distance": F.coalesce(_measured("classes"), F.lit(0.0)),
            "__word_distance": F.coalesce(_measured("commons"), F.lit(0.0)),
        }
    )
    words = F.col("__n_words")
    failed = (words < LEAST_WORDS) | (100 * F.col("__repeated") > MOST_REPEATED * words)
    odd = ((words >= MIN_WORDS) & (F.col("__class_distance") > MAX_CLASS_DISTANCE)) | (
        (words >= MIN_WORDS_COMMON) & (F.col("__word_distance") > MAX_WORD_DISTANCE)
    )
    return far.withColumns({"__failed": failed, "__kept": ~failed & ~odd})


def _measured(group: str) -> Column:
    arrays = "array(" + ", ".join(_GROUPS[group]) + ")"
    return distance(arrays, f"__ref_{group}")


def assess(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdicts per row of ``docs``."""
    docs = small_batches(docs)
    features = materialize(_features(docs.select("doc_id", "text", "lang"), ["doc_id"]), "quality")
    return _judged(features, references(features)).select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__word_chars").alias("word_chars"),
        F.col("__symbol").alias("n_symbols"),
        F.col("__dup_lines").alias("n_dup_lines"),
        F.col("__repeated").alias("n_repeat_words"),
        F.col("__class_distance").alias("class_distance"),
        F.col("__word_distance").alias("word_distance"),
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are."""
    # A row of counts per row, as a generator's output: filters on them are not moved below it,
    # where every use of a count would compute it anew.
    plain = plain_names(small_batches(docs), "text", "lang")
    features = _features(plain, plain.columns)
    counts = [c for c in features.columns if c not in plain.columns]
    features = features.select(*plain.columns, F.inline(F.array(F.struct(*counts))))
    reference = references(_counted(docs.select("text", "lang"), []))
    kept = _judged(features, reference).filter("__kept").select(*plain.columns)
    return kept.toDF(*docs.columns)


def verdicts(assessed: DataFrame) -> DataFrame:
    return assessed.drop("class_distance", "word_distance")
