"""Near-duplicates by bottom-k sketches from one hash function.

1. Texts with the same words are one class. Each class keeps the smallest ``SKETCH`` hashes of its shingle set.
2. Inverted lists over the ``LISTED`` smallest: two linked sets share at least ``need`` of them (but for a chance below
   ``CHANCE`` per pair; sets of up to ``LISTED`` shingles are held whole, and share what their similarity requires less what
   a larger partner's list lacks), so each class enters only the lists of its ``LISTED - need + 1`` rarest values, and a
   class with too many values of its own enters none. Values of common passages are not rare and drop out.
3. Lists of at most ``LONG_LIST`` classes give their pairs. Longer lists (large groups of near copies) do not: their full
   sets show how many shingles each member has to itself; members with too many cannot be linked to another member.
   The others form groups; every member is paired with the group's hub, the one nearest to what most members hold, and
   members that are not in the hub's component afterwards meet the others through lists of their differences from that.
4. The union of two sketches estimates the similarity and filters the pairs; exact Jaccard on full sets verifies them.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import stored, whole_text
from .sketch import hashes, let

SKETCH, LISTED, LONG_LIST = 64, 32, 64
HOPS = 3
CHANCE = 1e-9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def at_least(k: int, similarity: float) -> int:
    """The number of the k smallest values of a union that lie in both sets, but for a chance below CHANCE."""
    tail, s = 0.0, 0
    while s < k:
        tail += comb(k, s) * similarity**s * (1 - similarity) ** (k - s)
        if tail > CHANCE:
            break
        s += 1
    return s


def shingle_set(text: Column) -> Column:
    """The distinct hashes of the five-word shingles, ascending; none for a text without words."""
    return F.sort_array(F.array_distinct(hashes(text, fold=False)))


def plain(text: str) -> Column:
    return F.translate(whole_text(text), UPPER, LOWER)


def words_key(text: str) -> Column:
    """Equal for texts of equal words."""
    return F.unhex(F.sha2(F.btrim(F.regexp_replace(plain(text), r"[\x20\x09-\x0D]+", " "), F.lit(" ")), 256))


def linked_classes(df: DataFrame, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows: id, n, words; node and root of every class that is linked to another one)."""
    t = percent / 100
    full = let(
        shingle_set(plain(text)),
        lambda s: F.struct(F.size(s).cast("long").alias("n"), F.slice(s, 1, SKETCH).alias("sketch")),
    )
    rows = df.select(F.col(key).alias("id"), words_key(text).alias("words"), full.alias("full"))
    rows = stored(rows.select("id", "words", "full.*"), "sketches")
    classes = (
        rows.filter(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("words")
        .agg(F.min(F.struct("id", "n", "sketch")).alias("rep"))
        .select("words", F.col("rep.id").alias("node"), F.col("rep.n").alias("n"), F.col("rep.sketch").alias("sketch"))
    )
    classes = stored(classes, "classes")

    lists = stored(_lists(classes, t, percent), "lists")
    # Stored, so that the join below is no part of the counting: Spark may then split the rows of a long list.
    sizes = stored(lists.groupBy("value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "sizes")
    sized = lists.join(sizes, "value")
    short, long = sized.filter(F.col("members") <= LONG_LIST), sized.filter(F.col("members") > LONG_LIST)
    pairs = stored(_filtered(_pairs(short, percent), classes, t, percent), "pairs")
    long = stored(long.select("value", "node", "n"), "long")

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(long.select("node")).distinct()
    of_interest = classes.join(wanted, "node").select("node", F.col("words").alias("own_words"))
    # The texts are read again: sets are made only for the classes that take part in a pair or a long list.
    texts = df.select(F.col(key).alias("node"), F.col(text).alias("text"))
    sets = texts.join(of_interest, "node").filter(words_key("text") == F.col("own_words"))
    sets = stored(sets.select("node", shingle_set(plain("text")).alias("set")), "sets")

    links = stored(_verified(pairs, sets, percent), "links")
    if not long.isEmpty():
        links = _long_lists(long, sets, classes, links, t, percent)
    return rows, components(links.select(F.col("a").alias("node"), F.col("b").alias("other")))


def _lists(classes: DataFrame, t: float, percent: int) -> DataFrame:
    """(value, node, n): each class in the lists of its rarest values. Values that only one class has need no list, but
    take up its first places."""
    listed = F.slice("sketch", 1, LISTED)
    entries = classes.select("node", "n", F.size(listed).alias("k"), F.explode(listed).alias("value"))
    common = entries.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    shared = entries.join(common, "value").groupBy("node", "n", "k").agg(
        F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("values")  # at most LISTED entries
    )
    exact = F.floor((F.col("n") * percent + 99) / 100)
    # A partner has at most so many shingles that its list lacks; all of them may be shared ones.
    lacking = F.greatest(F.floor(F.col("n") * 100 / percent) - LISTED, F.lit(0))
    chance = F.lit(at_least(LISTED, t))
    need = (
        F.when(F.col("n") > LISTED, chance).when(lacking > 0, F.greatest(exact - lacking, chance)).otherwise(exact)
    )
    places = F.col("k") - need + 1 - (F.col("k") - F.size("values"))
    chosen = F.slice("values", F.lit(1), F.greatest(places, F.lit(0)).cast("int"))
    return shared.select("node", "n", F.explode(chosen).alias("e")).select("e.value", "node", "n")


def _pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of members of one list whose sizes allow the similarity."""
    one, two = lists.alias("one"), lists.alias("two")
    fits = (F.col("one.n") * 100 >= F.col("two.n") * percent) & (F.col("two.n") * 100 >= F.col("one.n") * percent)
    joined = one.join(two, (F.col("one.value") == F.col("two.value")) & (F.col("one.node") < F.col("two.node")) & fits)
    return joined.select(F.col("one.node").alias("a"), F.col("two.node").alias("b")).distinct()


def _filtered(pairs: DataFrame, classes: DataFrame, t: float, percent: int) -> DataFrame:
    """The pairs that the sketch of the union does not exclude."""
    a = classes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    b = classes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    union = F.slice(F.sort_array(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    both = F.array_intersect("sketch_a", "sketch_b")
    hits = F.size(F.array_intersect(union, both))
    # A union that the sketches hold whole is judged exactly.
    passes = F.when(F.size(union) < SKETCH, hits * 100 >= F.size(union) * percent).otherwise(
        hits >= at_least(SKETCH, t)
    )
    return pairs.join(a, "a").join(b, "b").filter(passes).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return pairs.join(a, "a").join(b, "b").filter(shared * 100 >= union * percent).select("a", "b").distinct()


def _long_lists(long: DataFrame, sets: DataFrame, classes: DataFrame, links: DataFrame, t: float, percent: int) -> DataFrame:
    """links and those between members of long lists, as far as components need them."""
    inside = sets.join(long.select("node").distinct(), "node").select("node", F.explode("set").alias("hash")).distinct()
    single = inside.groupBy("hash").agg(F.count(F.lit(1)).alias("holders"), F.min("node").alias("node")).filter("holders = 1")
    own = single.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    members = long.join(own, "node", "left").select("value", "node", "n", F.coalesce("own", F.lit(0)).alias("own"))
    members = stored(members.filter((F.col("n") - F.col("own")) * 100 >= F.col("n") * percent), "members")
    groups = stored(_groups(members), "groups")
    differ = stored(_differences(groups, sets), "differences")
    hubs = differ.groupBy("lead").agg(F.min(F.struct("size", "node")).alias("hub")).select("lead", F.col("hub.node").alias("hub"))
    spokes = groups.join(hubs, "lead").filter("node <> hub")
    with_hub = spokes.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = stored(links.union(_verified(_filtered(with_hub, classes, t, percent), sets, percent)).distinct(), "links")

    roots = components(links.select(F.col("a").alias("node"), F.col("b").alias("other")))
    return links.union(_further(differ, hubs, roots, percent)).distinct()


def _groups(members: DataFrame) -> DataFrame:
    """(lead, node, n): the members of each list, by the list's lead, its member with least of its own.

    Lists of one group of copies have different leads at first, and a member of several would be worked on once for each.
    A lead is a member of other lists too, and takes over the least lead of those: HOPS such steps join most lists of a group.
    Members of one list stay together, which is all that the links need; larger groups are as right.
    """
    leads = members.groupBy("value").agg(F.min(F.struct("own", "node")).alias("lead"))
    of_member = stored(members.join(leads, "value").groupBy("node").agg(F.min("lead").alias("least")), "leads")
    least = of_member.select(F.col("node").alias("lead_node"), "least")
    for _ in range(HOPS):
        leads = leads.withColumn("lead_node", F.col("lead.node")).join(least, "lead_node").select("value", F.col("least").alias("lead"))
    leads = leads.select("value", F.col("lead.node").alias("lead"))
    return members.join(leads, "value").select("lead", "node", "n").distinct()


def _differences(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(lead, node, n, core_n, size, d): where each member differs from its group's core, that is the shingles that more
    than half of the members hold (fewer than twice the shingles of an average member)."""
    held = groups.join(sets, "node").select("lead", F.explode("set").alias("hash"))
    holders = held.groupBy("lead", "hash").agg(F.count(F.lit(1)).alias("holders"))
    half = holders.join(groups.groupBy("lead").agg(F.count(F.lit(1)).alias("members")), "lead").filter("holders * 2 > members")
    core = half.groupBy("lead").agg(F.collect_set("hash").alias("core"))
    d = F.array_union(F.array_except("set", "core"), F.array_except("core", "set"))
    joined = groups.join(sets, "node").join(core, "lead", "left")
    joined = joined.withColumn("core", F.coalesce("core", F.array().cast("array<bigint>")))
    return joined.select("lead", "node", "n", F.size("core").alias("core_n"), d.alias("d")).withColumn("size", F.size("d"))


def _further(differ: DataFrame, hubs: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of a member outside its hub's component (Y) with another member of the same group (X).

    With Dx and Dy as their differences from the core C, X and Y differ in |Dx| + |Dy| - 2 |Dx & Dy| shingles, and a link
    allows c (|X| + |Y|), c = (1 - t) / (1 + t). Where Y is far from the core, |Dy| > c (|Y| + |C|), a link needs
    |Dx & Dy| > (|Dx| + c (|C| - |X|)) / 2: one of all but so many of the shingles in Dx, rarest first, lies in Dy. As
    a difference is small and partly a member's own, few meet.

    Where Y is near the core, let f(X) = |Dx| - c |X|. If f(X) + f(Y) <= 0, X and Y are linked whatever they share, and so is
    each of them with the member Z of least f, as f(Z) + f(X) <= f(Y) + f(X): links with Z give the same components.
    Otherwise they share (f(X) + f(Y)) / 2 differences or more, and meet in the list of one of each one's rarest. Where two meet, their differences give
    the exact Jaccard similarity of the full sets, so that the join yields links only.
    """
    c = (100 - percent) / (100 + percent)
    placed = differ.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(hubs, "lead")
    hub_roots = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    placed = placed.join(hub_roots, "hub", "left").withColumn("outside", F.col("root") != F.coalesce("hub_root", "hub"))
    placed = stored(placed.withColumn("far", F.col("size") > c * (F.col("n") + F.col("core_n"))), "placed")
    entries = placed.select("lead", "node", "n", "root", "outside", "far", "core_n", "size", F.explode("d").alias("hash"))
    common = entries.groupBy("lead", "hash").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    shared = stored(entries.join(common, ["lead", "hash"]), "shared")
    # As many entries as a set and its core have shingles.
    lists = shared.groupBy("lead", "node", "n", "core_n", "size").agg(
        F.sort_array(F.collect_set(F.struct("holders", "hash"))).alias("values")
    )
    whole = placed.select("lead", "node", "n", "root", "size", "d", "outside", "far")
    need = F.greatest(F.floor((F.col("size") + c * (F.col("core_n") - F.col("n")) - 1e-6) / 2) + 1, F.lit(1))
    places = F.col("size") - need + 1 - (F.col("size") - F.size("values"))
    first = F.slice("values", F.lit(1), F.greatest(places, F.lit(0)).cast("int"))
    one = lists.select("lead", "node", F.explode(first).alias("e")).select("lead", "node", "e.hash").join(whole, ["lead", "node"])
    two = shared.filter("outside and far").select("lead", "node", "hash").join(whole, ["lead", "node"])
    apart = F.col("one.size") + F.col("two.size") - 2 * F.size(F.array_intersect("one.d", "two.d"))
    both = F.col("one.n") + F.col("two.n")
    linked = _fit(percent) & ((both - apart) * 100 >= (both + apart) * percent)
    met = one.alias("one").join(two.alias("two"), (F.col("one.hash") == F.col("two.hash")) & linked)
    # Near the core: without a shared difference, by way of the member nearest to it ...
    excess = F.col("size") - c * F.col("n")
    nearest = whole.groupBy("lead").agg(F.min(F.struct(excess.alias("excess"), "node", "n", "root", "size", "d")).alias("best"))
    nearest = nearest.select("lead", "best.*").drop("excess")
    through = nearest.alias("one").join(whole.alias("two"), linked)
    # ... and with one, through the lists of the rarest: two that are linked share (f(X) + f(Y)) / 2 differences at least.
    least = whole.groupBy("lead").agg(F.min(excess).alias("least"))
    excessive = (F.col("size") - c * F.col("n") + F.col("least")) / 2
    overlap = F.greatest(F.ceil(excessive - 1e-6), F.lit(1))
    places = F.col("size") - overlap + 1 - (F.col("size") - F.size("values"))
    rarest = F.slice("values", F.lit(1), F.greatest(places, F.lit(0)).cast("int"))
    listed = lists.join(least, "lead").select("lead", "node", F.explode(rarest).alias("e"))
    listed = stored(listed.select("lead", "node", "e.hash").join(whole, ["lead", "node"]), "listed")
    near = listed.filter("outside and not far")
    beside = listed.alias("one").join(near.alias("two"), (F.col("one.hash") == F.col("two.hash")) & linked)
    ends = lambda df: df.select(F.least("one.node", "two.node").alias("a"), F.greatest("one.node", "two.node").alias("b"))
    return ends(met).union(ends(through)).union(ends(beside)).distinct()


def _fit(percent: int) -> Column:
    """Two members of a group in different components whose sizes allow the similarity."""
    return (
        (F.col("one.lead") == F.col("two.lead")) & (F.col("one.root") != F.col("two.root"))
        & (F.col("one.n") * 100 >= F.col("two.n") * percent) & (F.col("two.n") * 100 >= F.col("one.n") * percent)
    )


def near_duplicates(df: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (the smallest key reachable by links of ``percent`` per cent or more), kept.

    One row for every row of df. A null text counts as empty; a text without words is linked with nothing. Rows that
    share a key are one document. A row without a key is compared with nothing: its component is null, it is kept.
    Other columns are dropped, whatever their names; an empty df gives no rows.
    """
    rows, roots = linked_classes(df, percent, key, text)
    by_words = (
        rows.filter(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("words").agg(F.min("id").alias("node"))
        .join(roots, "node", "left").select("words", F.coalesce("root", "node").alias("component"))
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("id")))
    return rows.select("id", "n", "words").join(by_words, "words", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
