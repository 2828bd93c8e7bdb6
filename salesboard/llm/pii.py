r"""Personal data and what gives it away.

Base spans are email addresses, IP addresses, card and phone numbers by fixed
patterns and checks.  Beyond those, the corpus itself says which words reveal a
protected value: with ``N`` documents, a value ``e`` in ``df(e)`` of them, a word
``t`` in ``df(t)`` and the two together in ``df(e, t)``, at any distance,

    disclosure(e, t) = PMI(e, t) / IC(e)
                     = log2(N df(e, t) / (df(e) df(t))) / log2(N / df(e))

is the share of the value's information that the word gives (1: it gives it away).
In the documents that hold the value, the word is removed at every occurrence where
that reaches ``Limits.remove`` and replaced by its shape (number, code, name or word)
where it reaches ``Limits.generalise``; pairs seen in fewer than ``Limits.support``
different texts are chance.  A document gives the pairs of its own classes of values
and terms, so their number grows with the documents, not with products of groups.
Words that touch a base span are part of it.

DataFrame functions only.  Positions come from the pieces between matches: a text
is split by the pattern and the matches are read in the same order.  Patterns run
possessively and start only where a run begins, so long runs cost linear time.

Edge cases: a null text is empty and has no spans; repeated rows give a row each;
a value that occurs in every document carries no information and discloses nothing.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesboard.llm.arrays import running, stretch, text_blocks
from salesboard.llm.common import SPACE, small_side, whole_text, written
from salesboard.llm.rules import let, split_words


class Limits(NamedTuple):
    """Different texts that a pair needs, and the disclosures from which a word is generalised and removed.

    A value or pair that is in fewer texts than ``support`` is never acted on: a name that stands beside an address in
    one text alone stays.
    """

    support: int = 2
    generalise: float = 0.6
    remove: float = 0.8


# Patterns of the contract (fixed values), possessive and anchored at the start of a run.
_EMAIL = r"[A-Za-z0-9._%+-]"
PATTERNS = (
    ("email", rf"(?:\G|(?<!{_EMAIL})){_EMAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", None),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
KINDS = [k for k, _, _ in PATTERNS]
REMOVED, GENERALISED = "removed", "generalised"
#: Stands for a character of a base span.
_HIDDEN = "\uffff"
_MARK = "struct<word:string,action:string>"
_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    def weight(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    return F.aggregate(F.transform(F.filter(numbers, lambda d: d.isNotNull()), weight), F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))
    digits = F.regexp_replace(match, "[^0-9]+", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(digits)
    return F.length(digits).between(10, 15)


def _value(kind: str, match: Column) -> Column:
    """A spelling of the match that is the same for the same protected value."""
    return F.lower(match) if kind in ("email", "ip") else F.regexp_replace(match, "[^0-9]+", "")


def _found(text: Column, k: int) -> Column:
    """``spans`` and ``seen`` of one kind, null without a valid match.

    The ``i``-th match stands after the first ``i + 1`` pieces and the first ``i`` matches; ``seen`` is the text with
    the matches hidden but for their blanks.
    """
    kind, pattern, sign = PATTERNS[k]

    def placed(parts: Column, checked: Column) -> Column:
        gaps = F.zip_with(F.slice(parts, F.lit(1), F.size(checked)), checked, lambda p, x: F.length(p) + F.length(x["m"]))
        ends = F.zip_with(running(gaps, F.lit(0), lambda a, n: a + n), gaps, lambda before, n: before + n)
        spans = F.filter(F.zip_with(checked, ends, lambda x, end: F.struct(x["m"].alias("m"), x["ok"].alias("ok"), end.alias("end"))), lambda s: s["ok"])
        spans = F.transform(spans, lambda s: F.struct((s["end"] - F.length(s["m"])).alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), _value(kind, s["m"]).alias("value")))
        seen = F.zip_with(parts, checked, lambda p, x: F.concat(p, F.when(x["ok"], F.regexp_replace(x["m"], "[^ ]", _HIDDEN)).otherwise(F.coalesce(x["m"], F.lit("")))))
        return F.struct(spans.cast(f"array<{_SPAN}>").alias("spans"), F.array_join(seen, "").alias("seen"))

    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(m.alias("m"), _valid(kind, m).alias("ok")))
    found = let(matches, lambda c: F.when(F.exists(c, lambda x: x["ok"]), let(F.split(text, pattern), lambda parts: placed(parts, c))))
    holds = F.contains(text, F.lit(sign)) if sign else F.lit(True)
    if kind == "card":  # matches are many and mostly short: skip texts without fourteen digits
        holds = text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")
    return F.when(holds, found)


def _with_spans(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, ``base`` and ``touched``: for each piece between blanks, whether a base span covers some of it."""
    text = whole_text()

    def both(kinds: Column) -> Column:
        spans = F.flatten(F.transform(kinds, lambda x: F.coalesce(x["spans"], F.array().cast(f"array<{_SPAN}>"))))
        def flags(pieces: Column) -> Column:
            def changed(k: int) -> Column:
                return F.zip_with(F.split(kinds[k]["seen"], SPACE), pieces, lambda a, b: a != b)
            none = F.transform(pieces, lambda p: F.lit(False))
            return reduce(lambda acc, k: F.when(kinds[k]["seen"].isNull(), acc).otherwise(F.zip_with(acc, changed(k), lambda a, b: a | b)), range(len(PATTERNS)), none)
        touched = F.when(F.exists(kinds, lambda x: x["seen"].isNotNull()), let(F.split(text, SPACE), flags))
        return F.struct(F.array_sort(spans).alias("base"), touched.alias("touched"))
    found = docs.withColumn("spans of a text", let(F.array(*[_found(text, k) for k in range(len(PATTERNS))]), both))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], "`spans of a text`.base", "`spans of a text`.touched")


def with_base_spans(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``base``: the base spans by start, then kind."""
    return _with_spans(docs).drop("touched")


# --- disclosure -----------------------------------------------------------------

_SIGN = r"[^\p{L}\p{N}]"


def term(word: Column) -> Column:
    """The form in which a word is counted: lower case, without signs at either end; empty if nothing is left."""
    return F.lower(F.regexp_replace(word, rf"^{_SIGN}++|(?<!{_SIGN}){_SIGN}++$", ""))


def _distinct_terms(words: Column) -> Column:
    return F.array_remove(F.array_distinct(F.transform(F.array_distinct(words), term)), "")


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return _distinct_terms(split_words(text))


def _free_terms(text: Column, touched: Column) -> Column:
    """The distinct terms of a text outside its base spans."""
    free = F.filter(F.zip_with(F.split(text, SPACE), touched, lambda p, t: F.when(~t, p)), lambda p: p.isNotNull())
    return _distinct_terms(free)


def _information(n_docs: int, df: str) -> Column:
    return F.log2(F.lit(n_docs) / F.col(df))


def _texts() -> list[Column]:
    """Two hashes over the texts that hold something, and their number: equal for things of exactly the same texts."""
    return [F.bit_xor(F.xxhash64(F.lit(seed), F.col("text_key"))).alias(f"texts_{seed}") for seed in (1, 2)] + [F.count("*").alias("texts")]


def _class(*more: str) -> Column:
    """A class of things that stand in the same texts (``_texts``) and agree in ``more``."""
    return F.unhex(F.md5(F.concat_ws(":", "texts_1", "texts_2", "texts", *more)))


def disclosures(docs: DataFrame, spanned: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``text_key, marks``: the terms that reveal a value of each text of ``spanned``, by bucket (``_bucket``) as ``word, action``.

    ``spanned`` has ``text_key, text, base, touched`` for the documents with base spans, one row a document; counts cover all ``docs``.
    A pair is in no more documents than its word is, so words that tell less than ``generalise`` of the information of every
    value of a text are left out before pairing.  Values that stand in the same texts are one class, as are words of one
    document frequency that stand in the same texts: pairs are made of classes, so that a long list of addresses with its
    copies is a few pairs and not addresses times words.  The result is the same.
    """
    n_docs = docs.count()
    texts = spanned.groupBy("text_key").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("text", "base", "touched")])
    texts = written(texts.select("text_key", "copies", F.array_distinct(F.transform("base", lambda s: s["value"])).alias("values"), _free_terms(F.col("text"), F.col("touched")).alias("terms")), "texts")
    mentions = texts.select("text_key", "copies", F.explode("values").alias("value"))
    values = mentions.groupBy("value").agg(F.sum("copies").alias("df_value"), *_texts()).where((F.col("texts") >= limits.support) & (F.col("df_value") < n_docs))
    values = written(values.select("value", "df_value", _information(n_docs, "df_value").alias("information"), _class().alias("value_class")), "values")
    least = values.agg(F.min("information")).first()[0]
    if least is None:
        return spanned.select("text_key", F.lit(None).cast(f"map<int,array<{_MARK}>>").alias("marks")).limit(0)
    # documents of each term, over the whole table: each document counts once for a term, pre-aggregated by task
    words = docs.select(F.explode(terms(whole_text())).alias("word")).groupBy("word").agg(F.count("*").alias("df_word"))
    words = words.withColumn("most", _information(n_docs, "df_word") + 1e-9).where((F.col("df_word") >= limits.support) & (F.col("most") >= limits.generalise * least))
    words = written(words, "words")
    in_text = written(mentions.join(values, "value").select("text_key", "copies", "value_class", "df_value", "information").distinct(), "value-classes")
    text_least = in_text.groupBy("text_key").agg(F.min("information").alias("least"))
    beside = texts.join(text_least, "text_key").select("text_key", "least", F.explode("terms").alias("word"))
    tells = F.col("most") >= limits.generalise * F.col("least")
    classes = beside.join(words, "word").where(tells).groupBy("word").agg(*[F.first(c).alias(c) for c in ("df_word", "most")], *_texts()).where(F.col("texts") >= limits.support)
    classes = written(classes.select("word", "df_word", "most", _class("df_word").alias("word_class")), "word-classes")
    held = beside.join(classes, "word").where(tells).select("text_key", "word", "word_class", "df_word", "most")
    held_classes = held.drop("word").repartition("text_key").distinct()
    pairs = (held_classes.join(in_text, "text_key").where(F.col("most") >= limits.generalise * F.col("information"))
             .groupBy("value_class", "word_class").agg(F.sum("copies").alias("df_pair"), F.count("*").alias("texts"), *[F.first(c).alias(c) for c in ("df_value", "df_word", "information")])
             .where(F.col("texts") >= limits.support))
    given = F.log2(n_docs * F.col("df_pair") / (F.col("df_value") * F.col("df_word")))
    scored = written(pairs.select("value_class", "word_class", (given / F.col("information")).alias("disclosure")).where(F.col("disclosure") >= limits.generalise), "scored")
    told = held.join(small_side(scored.select("word_class").distinct()), "word_class").select("text_key", "word", "word_class")
    found = (told.select("text_key", "word_class").repartition("text_key").distinct().join(in_text.select("text_key", "value_class"), "text_key")
             .join(scored, ["value_class", "word_class"]).groupBy("text_key", "word_class").agg(F.max("disclosure").alias("d")))
    action = F.when(F.col("d") >= limits.remove, REMOVED).otherwise(GENERALISED)
    marks = told.join(found, ["text_key", "word_class"]).groupBy("text_key", _bucket(F.col("word")).alias("bucket")).agg(F.collect_list(F.struct("word", action.alias("action"))).alias("marks"))
    return marks.groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "marks"))).alias("marks"))  # terms of one text


def _bucket(word: Column) -> Column:
    """A text's marked terms are looked up in one of 256 short lists."""
    return F.pmod(F.hash(word), F.lit(256))


def _shape(word: Column) -> Column:
    """What a generalised word still tells: a number, a code of letters and digits, a name (capital first) or a plain word."""
    digit = word.rlike(r"\p{N}")
    return F.when(digit & ~word.rlike(r"\p{L}"), "[number]").when(digit, "[code]").when(word.rlike(r"^\P{L}*+\p{Lu}"), "[name]").otherwise("[word]")


def _marked_places(text: Column, touched: Column, marks: Column) -> Column:
    """``start, end, action, shape`` of every word of ``text`` outside its base spans whose term is marked, by start."""
    def action(piece: Column) -> Column:
        return let(term(piece), lambda t: F.get(F.filter(F.try_element_at(marks, _bucket(t)), lambda m: m["word"] == t), F.lit(0))["action"])

    def places(pieces: Column) -> Column:
        starts = running(F.transform(pieces, lambda p: F.length(p) + 1), F.lit(0), lambda a, n: a + n)
        acts = F.zip_with(pieces, touched, lambda p, t: F.struct(p.alias("p"), F.when(~t, action(p)).alias("action")))
        hits = F.filter(F.zip_with(acts, starts, lambda x, at: F.struct(at.alias("at"), x["p"].alias("p"), x["action"].alias("action"))), lambda h: h["action"].isNotNull())
        return F.transform(hits, lambda h: F.struct(h["at"].alias("start"), (h["at"] + F.length(h["p"])).alias("end"), h["action"].alias("action"), _shape(h["p"]).alias("shape")))
    return let(F.split(text, SPACE), places)


def sanitised_spans(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All columns of ``docs``, ``base`` and ``revealing``: an array of ``start, end, action, shape`` by start.

    ``docs`` itself has neither of the two, nor ``touched``, ``text_key`` or ``marks``; ``sanitise`` takes columns of any name.
    """
    none = F.array().cast("array<struct<start:int,end:int,action:string,shape:string>>")
    base = written(_with_spans(docs), "base-spans")
    held = F.size("base") > 0
    key = F.unhex(F.md5(whole_text().cast("binary")))
    spanned = base.where(held).withColumn("text_key", key)
    marked = disclosures(base, spanned.select("text_key", whole_text().alias("text"), "base", "touched"), limits)
    revealing = F.when(F.col("marks").isNotNull(), _marked_places(whole_text(), F.col("touched"), F.col("marks"))).otherwise(none)
    columns = [c for c in base.columns if c != "touched"]
    with_spans = spanned.join(marked, "text_key", "left").select(*columns, revealing.alias("revealing"))
    return base.where(~held).select(*columns, none.alias("revealing")).unionByName(with_spans)


def find(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_removed, n_generalised`` for every row."""
    d = sanitised_spans(docs.select("doc_id", "text"), limits)
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), F.concat_ws(":", names[s["kind"]], s["start"], s["end"]).alias("text")))
    more = F.transform("revealing", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), F.concat_ws(":", s["action"], s["start"], s["end"]).alias("text")))
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: s["text"]), ",")
    counts = [F.size(F.filter("base", _is_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return d.select("doc_id", *counts, F.sha2(joined(shown).cast("binary"), 256).alias("base_sha256"), joined(F.array_sort(F.concat(shown, more))).alias("spans"),
                    *[F.size(F.filter("revealing", _is_action(a))).cast("long").alias(f"n_{a}") for a in (REMOVED, GENERALISED)])


def _is_kind(k: int):
    return lambda s: s["kind"] == k


def _is_action(action: str):
    return lambda s: s["action"] == action


def sanitise(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the same columns and the text rewritten.

    A base span becomes its kind in brackets, a generalised word its shape in brackets
    (``[number]``, ``[code]``, ``[name]``, ``[word]``), a removed word nothing.  Of overlapping spans the first, at the same start the
    longer, stands for the stretch that they cover together.
    """
    # the caller's columns travel in one struct, so that none can meet a name used here
    d = sanitised_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), limits)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    def piece(start: Column, end: Column, by: Column) -> Column:
        return F.struct(start.alias("start"), (-end).alias("order"), end.alias("end"), by.alias("by"))
    all_spans = F.sort_array(F.concat(F.transform("base", lambda s: piece(s["start"], s["end"], names[s["kind"]])),
                                      F.transform("revealing", lambda s: piece(s["start"], s["end"], F.when(s["action"] == REMOVED, "").otherwise(s["shape"])))))
    # a span that starts before an earlier one has ended is covered by that one's mark
    def rewrite(spans: Column, blocks: Column) -> Column:
        ends = running(F.transform(spans, lambda s: s["end"]), F.lit(0), F.greatest)
        out = F.zip_with(spans, ends, lambda s, at: F.when(s["start"] >= at, F.concat(stretch(blocks, at, s["start"] - at), s["by"])))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(out, ""), stretch(blocks, last, F.length("text") - last))
    rewritten = F.when(F.size("base") > 0, let(all_spans, lambda spans: let(text_blocks(F.col("text")), lambda blocks: rewrite(spans, blocks)))).otherwise(F.col("text"))
    d = d.select("row", rewritten.alias("text"))
    return d.select(*[(F.col("text") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
