"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of canonical words: numbers, names (capitalised words
inside a sentence) and units after numbers turn into typed placeholders, other
words are lower-cased and lose their punctuation.  Windows of ``window``
canonical words of documents and benchmark items are hash-joined, so a question
with other numbers or names is found as well; so are windows of the plain
lower-cased words, which case and white space don't change and whose slots are
equal anyway, and an item's window counts that is found in either form.  Where matched windows of one
alignment hold placeholders, their slots must agree: an item's value always
stands against the same value of the document, whatever punctuation stands around it.
Where it stands against several, the most frequent one holds (then the item's
own, then the first), and windows with a slot of another don't count.  A
document is contaminated by an item when at least ``share`` of the item's
windows are found in it, or consecutive ones over at least ``run`` words.

Items shorter than a window are matched in whole; items under ``least`` words
are never matched.  Null and empty texts have no windows.  A document is an
(id, text) pair: rows that repeat both give one result.  Items that repeat an
id are told apart by their texts.  Only ids and texts are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklens.llm.shared import written

#: Bytes of item windows that may be broadcast; beyond, both sides are shuffled.
BROADCAST_BYTES = 64 << 20
_WINDOW_BYTES = 64
#: Longs of the bitmap of the items' first words (a power of two): 512 KB, whatever the items.
FILTER_WORDS = 1 << 16
_NAME, _NUMBER, _UNIT = "\ue000", "\ue001", "\ue002"
#: Fixed values.
UNITS = "mm cm m km in ft yd mi miles meters metres kilometers kilometres feet inches mg g kg lb lbs oz ton tons grams kilograms pounds ml l liters litres gallons s sec min h hr hours minutes seconds days weeks months years mph kmh kw w v a hz usd eur dollars euros cents percent degrees"


def _unmarked(text: Column) -> Column:
    """The text without the placeholders' own characters."""
    return F.when(F.contains(text, F.lit(_NAME)) | F.contains(text, F.lit(_NUMBER)) | F.contains(text, F.lit(_UNIT)), F.translate(text, _NAME + _NUMBER + _UNIT, "")).otherwise(text)


def _plain(text: Column) -> Column:
    """The text without words of punctuation alone, so that raw and canonical words stand at the same places."""
    return F.regexp_replace(_unmarked(text), r"(?=[^\p{L}\p{N}\s])(?<!\S)[^\p{L}\p{N}\s]+(?!\S)", " ")


def _words(text: Column) -> Column:
    # a text that begins or ends with white space has an empty word there
    return F.array_remove(F.split(text, r"\s+"), "")


def raw_words(text: Column) -> Column:
    return _words(_plain(text))


def canonical_words(text: Column) -> Column:
    """The canonical words; word i stands for word i of ``raw_words``."""
    # words of punctuation alone go with the last replacement: their letters and digits are none
    t = F.regexp_replace(_unmarked(text), r"(?=\p{Lu})(?<=[\p{L}\p{N}][ \t]|\S[,;][ \t])\p{Lu}\p{Ll}+", _NAME)
    t = F.regexp_replace(t, r"\p{N}[\p{N}.,]*(?<=\p{N})", _NUMBER)
    t = F.regexp_replace(t, f"{_NUMBER}([ \\t]?)(?i:" + "|".join(sorted(UNITS.split(), key=len, reverse=True)) + r")(?![\p{L}\p{N}])", f"{_NUMBER}$1{_UNIT}")
    return _words(F.lower(F.regexp_replace(t, f"[^a-zA-Z0-9\\s\\p{{L}}\\p{{N}}{_NAME}-{_UNIT}]+", "")))


def plain_words(text: Column) -> Column:
    """The lower-cased words without punctuation, at the places of ``raw_words``."""
    return _words(F.lower(F.regexp_replace(_unmarked(text), r"[^a-zA-Z0-9\s\p{L}\p{N}]+", "")))


def _value(word: Column) -> Column:
    """A slot's value: lower-cased, without the punctuation around it."""
    return F.regexp_replace(F.lower(word), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, whatever number of times it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _grams(words: Column, size: int) -> Column:
    """A number for ``size`` words (a power of two) from every place on: each pass joins two neighbours of the pass before."""
    if size == 1:
        return F.transform(words, lambda w: F.xxhash64(w))
    half = size // 2
    return _with(_grams(words, half), lambda g: F.transform(g, lambda x, i: F.xxhash64(x, F.get(g, i + half))))


def _key(grams: Column, at: Column, size: int, gram: int, plain: bool) -> Column:
    """A number for ``size`` words: that of the grams that cover them."""
    places = sorted({*range(0, size - gram + 1, gram), size - gram})
    return F.xxhash64(F.lit(plain), *(F.get(grams, at + p) for p in places))


def _word(key: Column) -> Column:
    return F.shiftright(key, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int")


def _bitmap(keys: DataFrame) -> Column:
    """``FILTER_WORDS`` longs with a bit for every ``key``, as a scalar subquery."""
    bits = keys.groupBy(_word(F.col("key")).cast("long").alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits"))
    every = keys.sparkSession.range(0, FILTER_WORDS, 1, 8).join(bits, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    return every.agg(F.sort_array(F.collect_list(F.struct("id", "bits"))).getField("bits").alias("bits")).scalar()


def _places(n: Column) -> Column:
    return F.when(n >= 0, F.sequence(F.lit(0), F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _one(value: Column, name: str) -> Column:
    """A column of its own: without the one-element array a plan holds the expression wherever it is used."""
    return F.explode(F.array(value)).alias(name)


def matches(docs: DataFrame, items: DataFrame, window: int = 8, least: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(id, th, item, ith, pos, doc_pos, size, plain, doc_words): windows of documents that equal one of an item, in plain form or only in the canonical one.

    A window is made a row only if the bit of its first words is set among
    those of the items (a bitmap of fixed size; the join is exact), and such
    rows carry their raw words, so no text is read again.
    """
    low = min(least, window)
    gram = 1 << (max(low, 1).bit_length() - 1)
    given = items.select(F.col(item_col).alias("item"), F.xxhash64("text").alias("ith"), canonical_words(F.col("text")).alias("words"), plain_words(F.col("text")).alias("plain")).distinct().where(F.size("words") >= least)
    given = given.select("item", "ith", F.least(F.size("words"), F.lit(window)).alias("size"), F.size("words").alias("n"), _one(F.struct(_grams(F.col("words"), gram).alias("words"), _grams(F.col("plain"), gram).alias("plain")), "g")).select("item", "ith", "size", "n", "g.*")
    forms = (("words", False), ("plain", True))
    own_key = lambda c, i, plain: F.coalesce(*(F.when(F.col("size") == s, _key(F.col(c), i, s, gram, plain)) for s in range(low, window + 1)))
    own = F.transform(_places(F.col("n") - F.col("size")), lambda i: F.array(*(F.struct(F.lit(plain).alias("plain"), own_key(c, i, plain).alias("key"), F.get(c, i).alias("head")) for c, plain in forms)))
    wins = given.select("item", "ith", "size", F.posexplode(own).alias("pos", "both"))
    wins = written(wins.select("item", "ith", "size", "pos", F.explode("both").alias("w")).select("item", "ith", "size", "pos", "w.*"), "item-windows")
    sizes = [r.size_ for r in wins.select(F.col("size").alias("size_")).distinct().collect()]  # at most window - least + 1 numbers
    side = F.broadcast(wins.drop("head")) if wins.count() * _WINDOW_BYTES <= BROADCAST_BYTES else wins.drop("head")
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), text.alias("text"), _bitmap(wins.select(F.col("head").alias("key"))).alias("bits"))

    def found_in(words: Column, plain: bool) -> Column:
        """(size, doc_pos, key) of the windows whose first words may begin a window of an item."""

        def of(g: Column) -> Column:
            known = lambda i: F.getbit(F.get("bits", _word(F.get(g, i))), F.get(g, i).bitwiseAND(F.lit(63)).cast("int")) == 1
            sized = lambda size: F.transform(F.filter(_places(F.size(g) - size), known), lambda i: F.struct(F.lit(size).alias("size"), i.alias("doc_pos"), _key(g, i, size, gram, plain).alias("key")))
            return F.concat(F.array().cast("array<struct<size:int,doc_pos:int,key:bigint>>"), *(sized(size) for size in sorted(sizes)))

        return _with(_grams(words, gram), of)

    both = F.concat(found_in(canonical_words(F.col("text")), False), found_in(plain_words(F.col("text")), True))
    held = src.select("id", "th", "text", _one(both, "w")).where(F.size("w") > 0)
    held = held.select("id", "th", "w", _one(raw_words(F.col("text")), "raw"))
    keyed = held.select("id", "th", F.explode(F.transform("w", lambda w: F.struct(w["size"].alias("size"), w["doc_pos"].alias("doc_pos"), w["key"].alias("key"), F.slice("raw", w["doc_pos"] + 1, w["size"]).alias("doc_words")))).alias("w"))
    found = keyed.select("id", "th", "w.*").join(side, ["key", "size"])
    return found.groupBy("id", "th", "item", "ith", "pos", "doc_pos", "size").agg(F.max("plain").alias("plain"), F.first("doc_words").alias("doc_words"))


def contaminated(docs: DataFrame, items: DataFrame, window: int = 8, share: float = 0.5, least: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", run: int = 13) -> DataFrame:
    """(id, th, item, n_matched, n_windows, n_slots): contaminated documents with the items they hold; th is the text's hash."""
    keys = ["id", "th", "item", "ith"]
    given = items.select(F.col(item_col).alias("item"), F.xxhash64("text").alias("ith"), canonical_words(F.col("text")).alias("words"), raw_words(F.col("text")).alias("raw")).distinct()
    totals = given.select("item", "ith", (F.size("words") - F.least(F.size("words"), F.lit(window)) + 1).alias("n_windows"))
    hits = matches(docs, items, window, least, id_col, text_col, item_col)
    hits = written(hits, "hits")
    totals = totals.select(F.col("item").alias("i"), F.col("ith").alias("it"), "n_windows")
    per = hits.groupBy(*keys).agg(F.count_distinct("pos").alias("n"), F.max("size").alias("s")).join(totals, F.col("item").eqNullSafe(F.col("i")) & (F.col("ith") == F.col("it")))
    per = per.where((F.col("n") >= share * F.col("n_windows")) | (F.col("n") + F.col("s") - 1 >= run))
    per = per.select(F.col("id").alias("pi"), F.col("th").alias("pt"), F.col("item").alias("pm"), F.col("ith").alias("pn"), "n_windows")
    near = hits.join(per, F.col("id").eqNullSafe(F.col("pi")) & (F.col("th") == F.col("pt")) & F.col("item").eqNullSafe(F.col("pm")) & (F.col("ith") == F.col("pn"))).drop("pi", "pt", "pm", "pn")
    slot = F.filter(F.sequence(F.lit(0), F.col("size") - 1), lambda k: F.get(F.col("words"), F.col("pos") + k).rlike(f"[{_NAME}-{_UNIT}]"))
    items_ = given.select(F.col("item").alias("i"), F.col("ith").alias("it"), "words", "raw")
    slots = near.join(items_, (F.col("item").eqNullSafe(F.col("i"))) & (F.col("ith").eqNullSafe(F.col("it")))).withColumn("slots", slot)
    both = F.transform("slots", lambda k: F.struct((F.col("pos") + k).alias("at"), _value(F.get(F.col("raw"), F.col("pos") + k)).alias("value"), _value(F.get("doc_words", k)).alias("doc_value")))
    slots = written(slots.select(*keys, "n_windows", "pos", "doc_pos", "size", "plain", both.alias("slots")), "slots")
    pairs = slots.select(*keys, (F.col("doc_pos") - F.col("pos")).alias("off"), F.explode("slots").alias("s")).distinct()
    held = pairs.select(*keys, "off", "s.*")
    votes = held.groupBy(*keys, "off", "value", "doc_value").agg(F.struct(F.count(F.lit(1)), F.max(F.col("doc_value") == F.col("value")), -F.min("at"), "doc_value").alias("vote"), F.collect_list("at").alias("ats"))
    against = votes.withColumn("best", F.max("vote").over(Window.partitionBy(*keys, "off", "value"))).where(F.col("vote") != F.col("best"))
    clash = against.groupBy(*keys, "off").agg(F.flatten(F.collect_list("ats")).alias("wrong"))
    c = clash.select(F.col("id").alias("ci"), F.col("th").alias("ct"), F.col("item").alias("cm"), F.col("ith").alias("cn"), F.col("off").alias("co"), "wrong")
    slotted = slots.withColumn("off", F.col("doc_pos") - F.col("pos")).join(c, F.col("id").eqNullSafe(F.col("ci")) & F.col("th").eqNullSafe(F.col("ct")) & F.col("item").eqNullSafe(F.col("cm")) & F.col("ith").eqNullSafe(F.col("cn")) & (F.col("off") == F.col("co")), "left")
    good = slotted.where(F.col("plain") | F.col("wrong").isNull() | ~F.exists("slots", lambda x: F.array_contains("wrong", x["at"])))
    # windows that follow each other in one alignment have one number
    good = good.withColumn("island", F.col("pos") - F.row_number().over(Window.partitionBy(*keys, "off").orderBy("pos")))
    good = good.withColumn("run", F.count(F.lit(1)).over(Window.partitionBy(*keys, "off", "island")) + F.col("size") - 1)
    out = good.groupBy(*keys, "n_windows").agg(F.count_distinct("pos").alias("n_matched"), F.max(F.size("slots")).cast("long").alias("n_slots"), F.max("run").alias("longest"))
    out = out.where((F.col("n_matched") >= share * F.col("n_windows")) | (F.col("longest") >= run))
    return out.select("id", "th", "item", "n_matched", F.col("n_windows").cast("long").alias("n_windows"), "n_slots")


def clean(docs: DataFrame, items: DataFrame, window: int = 8, share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without the contaminated ones."""
    bad = contaminated(docs, items, window, share, id_col=id_col, text_col=text_col).select("id", "th").distinct()
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th")).alias("own"), F.struct("*").alias("row"))
    left = rows.join(bad, F.col("own.id").eqNullSafe(F.col("id")) & (F.col("own.th") == F.col("th")), "left_anti")
    return left.select("row.*")
