"""Closed frequent sets over bitmaps, cluster by cluster, and what follows from them.

A set is closed if no larger set is held by the same baskets. Each frequent set has the
frequency of the smallest closed set around it, so the closed ones say as much as all, and
copies of a long basket make one set where all subsets would be listed otherwise.

Baskets of a cluster are numbered and cut into chunks of 64; a word has one row ``(chunk,
bits)`` for every chunk that holds it. A level joins the bits of the sets at hand with those
of all words on the chunk, so a cluster of any size is as many keys as it has chunks. A set is
extended by words behind its last one only, and an extension stays if its closure brings no
word before it: every closed set is found once, nothing has to be compared with earlier ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import scale
from ..session import stored

CHUNK = 64


@dataclass(frozen=True)
class ClosedSets:
    """Result of :func:`closed_sets`; all tables are stored.

    ``sets``: ``cluster, set_id, items, freq, further``, with words of ``items`` in order and ``further``
    as structs ``(item, n)`` of the words outside that enough baskets of the set hold too.
    ``members``: ``cluster, set_id, chunk, bits`` of the baskets that hold a set (among others). ``words``: ``cluster,
    item, freq`` and ``word_bits``: ``cluster, item, chunk, bits`` of frequent words. ``sizes``: ``cluster,
    n_baskets, need``. ``places``: ``cluster, chunk, bit`` and the basket's id.
    """

    cluster: str
    sets: DataFrame
    members: DataFrame
    words: DataFrame
    word_bits: DataFrame
    sizes: DataFrame
    places: DataFrame


def _ones(bits: Column) -> Column:
    return F.sum(F.bit_count(bits))


def _bitmaps(baskets: DataFrame, cluster: str, basket: str, items: str) -> tuple[DataFrame, DataFrame]:
    """Place of every basket, and ``cluster, word, chunk, bits`` of every word."""
    rows = baskets.select(cluster, F.col(basket), F.col(items).alias("_items")).where(F.col(cluster).isNotNull())
    key = F.coalesce(F.col(basket).cast("string"), F.lit(""))
    numbered = scale.number_rows(rows, [cluster], F.col(basket), scale.hash_bucket(key, 4096), "_number")
    number = F.col("_number") - 1
    placed = stored(numbered.select(cluster, basket, F.floor(number / CHUNK).alias("chunk"), (number % CHUNK).cast("int").alias("bit"),
                                    "_items"), "basket-places")
    held = placed.select(cluster, "chunk", F.expr("shiftleft(1L, bit)").alias("_one"), F.explode(F.array_distinct("_items")).alias("word"))
    bits = held.where(F.col("word").isNotNull()).groupBy(cluster, "word", "chunk").agg(F.bit_or("_one").alias("bits"))
    return placed.select(cluster, basket, "chunk", "bit"), bits


def closed_sets(baskets: DataFrame, cluster: str, basket: str, items: str = "items", min_support: float = 0.01) -> ClosedSets:
    """Closed sets of words that at least ``min_support`` of the baskets of their cluster hold.

    ``basket`` is an id of the row. A word counts once per basket; null and empty baskets hold nothing but
    count as baskets; null words are no words; rows without a cluster are left out. Levels go on until no
    extension is left; the driver sees one count per level.
    """
    places, bits = _bitmaps(baskets, cluster, basket, items)
    bits = stored(bits, "word-bitmaps")
    sizes = places.groupBy(cluster).agg(F.count("*").alias("n_baskets"))
    sizes = stored(sizes.withColumn("need", F.greatest(F.lit(1), F.ceil(F.round(F.col("n_baskets") * min_support, 9)))), "basket-numbers")
    freq = bits.groupBy(cluster, "word").agg(_ones(F.col("bits")).alias("freq")).join(F.broadcast(sizes), cluster)
    # At most (words of a basket) / min_support words of a cluster are frequent.
    rising = Window.partitionBy(cluster).orderBy("freq", "word")
    words = freq.where("freq >= need").select(cluster, "word", "freq", "n_baskets", F.row_number().over(rising).alias("item"))
    words = stored(words, "frequent-words")
    table = stored(bits.join(words.select(cluster, "word", "item"), [cluster, "word"]).select(cluster, "item", "chunk", "bits"), "frequent-bitmaps")

    everywhere = F.sort_array(F.collect_list(F.when(F.col("freq") == F.col("n_baskets"), F.col("item"))))
    further = F.sort_array(F.collect_list(F.when(F.col("freq") < F.col("n_baskets"), F.struct("item", F.col("freq").alias("n")))))
    roots = words.groupBy(cluster).agg(everywhere.alias("items"), further.alias("further"), F.max("n_baskets").alias("freq"))
    roots = stored(roots.select(cluster, F.lit("0").alias("set_id"), "items", "freq", "further", F.lit(0).alias("core")), "closed-level")
    whole = places.groupBy(cluster, "chunk").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    members = stored(whole.select(cluster, F.lit("0").alias("set_id"), "chunk", "bits"), "closed-members")

    levels, holders = [roots.where(F.size("items") > 0)], [members]
    level = roots
    while True:
        # Every extension as its own set: the parent's words, its own word, how many hold it.
        ahead = F.filter("further", lambda f: f["item"] > F.col("core"))
        tried = level.select(cluster, "set_id", F.col("items").alias("parent"), F.explode(ahead).alias("_f"))
        tried = tried.select(cluster, F.col("set_id").alias("of"), F.concat_ws(".", "set_id", "_f.item").alias("set_id"), "parent",
                             F.col("_f.item").alias("core"), F.col("_f.n").alias("freq"))
        if tried.isEmpty():
            break
        own = table.withColumnRenamed("item", "core").withColumnRenamed("bits", "_with")
        met = members.withColumnRenamed("set_id", "of").join(tried.select(cluster, "of", "set_id", "core"), [cluster, "of"])
        met = met.join(own, [cluster, "chunk", "core"]).withColumn("bits", F.col("bits").bitwiseAND(F.col("_with")))
        met = stored(met.where("bits <> 0").select(cluster, "set_id", "chunk", "bits"), "closed-met")
        both = met.join(table.withColumnRenamed("bits", "_with"), [cluster, "chunk"])
        both = both.withColumn("_both", F.col("bits").bitwiseAND(F.col("_with"))).where("_both <> 0")
        counts = both.groupBy(cluster, "set_id", "item").agg(_ones(F.col("_both")).alias("n"))
        counts = counts.join(tried.join(F.broadcast(sizes), cluster).drop("of", "n_baskets"), [cluster, "set_id"]).where("n >= need")
        closure = F.sort_array(F.collect_list(F.when(F.col("n") == F.col("freq"), F.col("item"))))
        further = F.sort_array(F.collect_list(F.when(F.col("n") < F.col("freq"), F.struct("item", "n"))))
        level = counts.groupBy(cluster, "set_id").agg(
            closure.alias("items"), further.alias("further"), F.first("freq").alias("freq"), F.first("core").alias("core"), F.first("parent").alias("parent")
        )
        news = F.exists("items", lambda i: (i < F.col("core")) & ~F.array_contains("parent", i))
        level = stored(level.where(~news).select(cluster, "set_id", "items", "freq", "further", "core"), "closed-level")
        levels.append(level)
        # Also of sets that did not stay; whoever reads this joins it with the sets.
        members = met
        holders.append(members)
    sets = reduce(DataFrame.unionByName, levels)
    names = words.groupBy(cluster).agg(F.map_from_entries(F.collect_list(F.struct("item", "word"))).alias("_names"))
    named = sets.join(names, cluster).select(
        cluster, "set_id", F.sort_array(F.transform("items", lambda i: F.col("_names")[i])).alias("items"), "freq",
        F.transform("further", lambda f: F.struct(F.col("_names")[f["item"]].alias("item"), f["n"].alias("n"))).alias("further"),
    )
    word_names = words.select(cluster, F.col("word").alias("_word"), "item")
    word_bits = table.join(word_names, [cluster, "item"]).select(cluster, F.col("_word").alias("item"), "chunk", "bits")
    return ClosedSets(cluster, stored(named, "closed-sets"), reduce(DataFrame.unionByName, holders),
                      words.select(cluster, F.col("word").alias("item"), "freq"), word_bits, sizes, places)


def frequent_closed_sets(found: ClosedSets) -> DataFrame:
    """``(cluster, items, size, freq)``, items in alphabetical order."""
    return found.sets.select(found.cluster, "items", F.size("items").alias("size"), "freq")


def frequency_of(found: ClosedSets, wanted: DataFrame, items: str = "items") -> DataFrame:
    """``wanted`` (``cluster, items``, each row once) with ``freq``: that of the smallest closed set around it, null if infrequent.

    A set is looked up by its rarest word, so it meets the closed sets with that word only.
    """
    cluster = found.cluster
    key = F.to_json(items)
    rows = wanted.select(cluster, key.alias("_key"), F.col(items).alias("_wanted"), F.explode(items).alias("item"))
    rarest = rows.join(found.words, [cluster, "item"]).groupBy(cluster, "_key").agg(
        F.min_by("item", F.struct("freq", "item")).alias("item"), F.first("_wanted").alias("_wanted"), F.count("*").alias("_known")
    )
    rarest = rarest.where(F.col("_known") == F.size("_wanted"))
    listed = found.sets.select(cluster, F.col("items").alias("_set"), "freq", F.explode("items").alias("item"))
    met = rarest.join(listed, [cluster, "item"]).where(F.size(F.array_except("_wanted", "_set")) == 0)
    best = met.groupBy(cluster, "_key").agg(F.max("freq").alias("freq"))
    return wanted.withColumn("_key", key).join(best, [cluster, "_key"], "left").drop("_key")


def closed_rules(found: ClosedSets, min_confidence: float = 0.1) -> DataFrame:
    """``(cluster, antecedent, consequent, confidence, lift, support)``, one word as consequent.

    Antecedents are the closed sets: any other set gives the figures of the closed set around
    it, and every word of that set with confidence 1.
    """
    cluster = found.cluster
    rows = found.sets.select(cluster, "items", "freq", F.explode("further").alias("_f"))
    rows = rows.select(cluster, "items", (F.col("_f.n") / F.col("freq")).alias("confidence"), F.col("_f.item").alias("item"), "_f.n")
    rows = rows.where(F.col("confidence") >= min_confidence)
    rows = rows.join(found.words, [cluster, "item"]).join(F.broadcast(found.sizes), cluster)
    return rows.select(
        cluster, F.col("items").alias("antecedent"), F.array("item").alias("consequent"), "confidence",
        (F.col("confidence") / (F.col("freq") / F.col("n_baskets"))).alias("lift"), (F.col("n") / F.col("n_baskets")).alias("support"),
    )


def predicted_words(found: ClosedSets, basket: str, min_confidence: float = 0.1) -> DataFrame:
    """``(cluster, basket, prediction)``: what the rules suggest to the baskets they come from and these do not hold.

    The baskets that hold a set and lack a word are the bits of the set without those of the
    word; they are merged over all sets that suggest the word before any basket is named. A
    basket without suggestions gets an empty array.
    """
    cluster = found.cluster
    suggested = found.sets.select(cluster, "set_id", "freq", F.explode("further").alias("_f"))
    suggested = suggested.where(F.col("_f.n") / F.col("freq") >= min_confidence).select(cluster, "set_id", F.col("_f.item").alias("item"))
    reached = found.members.join(suggested, [cluster, "set_id"]).groupBy(cluster, "item", "chunk").agg(F.bit_or("bits").alias("_reached"))
    lacking = reached.join(found.word_bits, [cluster, "item", "chunk"], "left")
    lacking = lacking.withColumn("_left", F.col("_reached").bitwiseAND(F.bitwise_not(F.coalesce("bits", F.lit(0).cast("long")))))
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda b: F.expr("_left").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b)) != 0))
    told = lacking.where("_left <> 0").select(cluster, "chunk", "item", bit.alias("bit"))
    told = told.groupBy(cluster, "chunk", "bit").agg(F.sort_array(F.collect_list("item")).alias("prediction"))
    both = found.places.join(told, [cluster, "chunk", "bit"], "left")
    return both.select(cluster, basket, F.coalesce("prediction", F.array().cast("array<string>")).alias("prediction"))
