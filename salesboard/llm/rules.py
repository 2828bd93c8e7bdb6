r"""Quality rules: base counts and divergence from the language's own statistics.

Base counts come from the words ``[^\x20\x09-\x0D]+`` and lines of a whole text.
For the verdict, a document's histogram over character classes and its histogram
over the most common words of its language (lower case) are compared with those of
the whole language by Jensen-Shannon distance (base 2, 0 to 1).  The references are counted
over all documents of the table.  Two guards keep thin evidence out: documents
below ``MIN_WORDS`` words and languages below ``MIN_REFERENCE_WORDS`` words are
judged by the base rules alone.

DataFrame functions only.  Repeated words are found inside the row: window hashes
are built by doubling (1, 2, 4, 8 words), and only a text with equal hashes sorts
them to see which words the repeated windows cover.

Edge cases: a null text is empty (no words, fails the base rule); a null language
is a language of its own; repeated rows give a row each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesboard.llm.common import SPACE, small_side, whole_text, written

#: Base rules.
LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED_PERCENT = 20, 8, 30
#: Common words of a language's reference, guards and largest accepted distances.
COMMON_WORDS = 24
MIN_WORDS, MIN_REFERENCE_WORDS = 50, 2000
CLASS_DISTANCE, WORD_DISTANCE = 0.30, 0.42
#: Character classes, counted in this order; what is left over is the last class.
CLASSES = (("lower", "[a-z]+"), ("space", SPACE + "+"), ("upper", "[A-Z]+"), ("letter", r"\p{L}+"), ("digit", "[0-9]+"), ("stop", r"[.,;:!?'\"()-]+"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    """Words of a text: a plain one-character split, once every separator is a space."""
    for mark in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _window_hashes(words: Column, n: Column) -> Column:
    """A hash of every eight consecutive words (``n`` of at least eight)."""
    def paired(step: int, size: Column) -> Callable[[Column], Column]:
        return lambda h: F.zip_with(F.slice(h, F.lit(1), size), F.slice(h, F.lit(step + 1), size), lambda a, b: F.xxhash64(a, b))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for step, fewer in ((1, 1), (2, 3), (4, 7)):
        hashes = let(hashes, paired(step, n - fewer))
    return hashes


def _covered(hashes: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more."""
    zipped = F.sort_array(F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(0), F.size(hashes) - 1).alias("p")))
    def twice(s: Column) -> Column:
        return F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    places = F.sort_array(F.transform(let(zipped, twice), lambda x: x["p"]))
    start = F.struct(F.lit(0).alias("c"), F.lit(-REPEAT_WINDOW).alias("last"))
    return F.aggregate(places, start, lambda acc, p: F.struct((acc["c"] + F.least(F.lit(REPEAT_WINDOW), p - acc["last"])).alias("c"), p.alias("last")), lambda acc: acc["c"])


def base_counts(docs: DataFrame, *carried: str) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, the ``carried`` columns, the whole ``text`` and its ``words``, for every row."""
    kept = [c for c in carried if c not in ("doc_id", "text")]
    d = docs.select("doc_id", *kept, whole_text().alias("text"))
    d = d.withColumn("words", split_words(F.col("text")))
    d = d.withColumn("n", F.size("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("lines", lines).withColumn("hashes", F.when(F.col("n") >= REPEAT_WINDOW, _window_hashes(F.col("words"), F.col("n"))))
    repeated = F.when(F.size("hashes") > F.size(F.array_distinct("hashes")), _covered(F.col("hashes"))).otherwise(0)
    d = d.select("doc_id", *kept, "text", "words", F.col("n").cast("long").alias("n_words"),
                 F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.when(F.col("n") >= REPEAT_WINDOW, repeated).otherwise(0).cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))


def class_counts(text: Column) -> Column:
    """Characters of each class: every class is taken out in turn, so later ones scan what little is left."""
    def step(rest: Column, k: int) -> Column:
        if k == len(CLASSES):
            return F.array(F.length(rest).cast("double"))
        return let(F.regexp_replace(rest, CLASSES[k][1], ""), lambda r: F.concat(F.array((F.length(rest) - F.length(r)).cast("double")), step(r, k + 1)))
    return step(text, 0)


def language_key() -> Column:
    """The language as a key that joins: a null one is told apart from an empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))


def references(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """``language`` (as a key), ``class_share array<double>, common array<string>, common_share array<double>`` over all documents.

    Only languages with enough words; there is one row for each.
    """
    d = docs.select(language_key().alias("language"), whole_text().alias("text"))
    n_classes = len(CLASSES) + 1
    chars = d.select("language", class_counts(F.col("text")).alias("c")).groupBy("language").agg(*[F.sum(F.col("c")[k]).alias(f"c{k}") for k in range(n_classes)])
    total = sum((F.col(f"c{k}") for k in range(1, n_classes)), F.col("c0"))
    chars = chars.select("language", F.array(*[F.col(f"c{k}") / total for k in range(n_classes)]).alias("class_share"))
    counts = d.select("language", F.explode(split_words(F.lower("text"))).alias("word")).groupBy("language", "word").agg(F.count("*").alias("n"))
    counts = written(counts, "language-words")
    sizes = counts.groupBy("language").agg(F.sum("n").alias("total")).where(F.col("total") >= MIN_REFERENCE_WORDS)
    order = Window.partitionBy("language").orderBy(F.desc("n"), "word")
    top = (counts.withColumn("k", F.row_number().over(order)).where(F.col("k") <= common)
           .groupBy("language").agg(F.sort_array(F.collect_list(F.struct("k", "word", "n"))).alias("top")))  # `common` entries
    return (sizes.join(top, "language").join(chars, "language")
            .select("language", "class_share", F.col("top.word").alias("common"),
                    F.concat(F.transform("top.n", lambda n: n / F.col("total")),
                             F.array(1 - F.aggregate("top.n", F.lit(0.0), lambda a, n: a + n) / F.col("total"))).alias("common_share")))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms that each sum to 1."""
    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(p, q, lambda a, b: (term(a, b) + term(b, a)) / 2), F.lit(0.0), lambda s, x: s + x)))


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts, ``base_failed, class_distance, word_distance, kept`` for every row."""
    refs = small_side(written(references(docs), "references"))
    d = base_counts(docs, "lang").withColumn("language", language_key()).join(refs, "language", "left")
    judged = (F.col("n_words") >= MIN_WORDS) & F.col("common").isNotNull()
    codes = F.transform("words", lambda w: F.array_position("common", F.lower(w)))
    d = d.withColumn("codes", F.when(judged, F.filter(codes, lambda c: c > 0)))
    d = d.withColumn("classes", F.when(judged, class_counts(F.col("text"))))
    in_class = F.transform("classes", lambda c: c / F.aggregate("classes", F.lit(0.0), lambda a, x: a + x))
    at = [(F.size("codes") - F.size(F.array_remove("codes", F.lit(k).cast("long")))) / F.col("n_words") for k in range(1, COMMON_WORDS + 1)]
    # a language with fewer different words than bins has no codes for the others
    in_common = F.concat(F.slice(F.array(*at), F.lit(1), F.size("common")), F.array((F.col("n_words") - F.size("codes")) / F.col("n_words")))
    d = d.withColumn("class_distance", F.when(judged, js_distance(in_class, F.col("class_share"))))
    d = d.withColumn("word_distance", F.when(judged, js_distance(in_common, F.col("common_share"))))
    far = F.coalesce((F.col("class_distance") > CLASS_DISTANCE) | (F.col("word_distance") > WORD_DISTANCE), F.lit(False))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance",
                    (~F.col("base_failed") & ~far).alias("kept"))
