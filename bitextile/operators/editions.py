"""Editions and catalogs: which to take, which to leave."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import release, written
from .graph import roots

#: Verdicts on two editions that make one of them redundant.
REDUNDANT = ("dialect_variant", "orthography_convention", "near_identical")


def preferred(rows: DataFrame, group: list[str], source: str, order: list[str], tie: str) -> DataFrame:
    """One row for each group, of the source that stands first in `order` (others last)."""
    rank = F.coalesce(*(F.when(F.col(source) == s, k) for k, s in enumerate(order)), F.lit(len(order)))
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(rank, tie))).where("__r = 1").drop("__r")


def plan(all_: DataFrame, done: DataFrame, excluded: DataFrame, key: str = "iso", editions: DataFrame | None = None, without: str | None = None) -> DataFrame:
    """What is neither done nor excluded; with editions (key, source) also has one, and with `without` none of that source."""
    out = all_.join(done.select(key), key, "left_anti").join(excluded.select(key), key, "left_anti")
    if editions is not None:
        out = out.join(editions.select(key), key, "left_semi")
        out = out if without is None else out.join(editions.where(F.col("source") == without).select(key), key, "left_anti")
    return out


def tested(rules: DataFrame, testaments: tuple[str, ...] = ("nt", "ot")) -> DataFrame:
    """iso and the testament that an exclusion rule takes out; 'all' takes out each."""
    each = F.explode(F.when(F.col("testament") == "all", F.array(*map(F.lit, testaments))).otherwise(F.array("testament"))).alias("testament")
    return rules.select("iso", each).distinct()


def versions(catalog: DataFrame, portions: DataFrame) -> DataFrame:
    """Versions of a language from all sources; portions of one version are one row with their parts sorted.

    catalog and portions: iso, source, edition, canon.
    """
    both = catalog.unionByName(portions, allowMissingColumns=True)
    return both.groupBy("iso", "source", "edition").agg(F.array_join(F.array_sort(F.collect_set("canon")), "+").alias("canon"))


def pick_family(families: DataFrame, order: list[str]) -> DataFrame:
    """One edition of each family of equal texts (root), by source priority."""
    return preferred(families, ["root"], "source", order, "edition")


def catalog_versions(clusters: DataFrame, index: DataFrame, listed: DataFrame, own: str = "pkf") -> DataFrame:
    """All known editions: iso, testament, key (source:edition), source, edition, anchor, fetchable, likely, closest.

    clusters: iso, canon, ids (keys of one text), reachable, likely, closest; the first id is the anchor of the others, and a
    portion (canon with p behind) counts for its testament. For a language and testament that index (iso, canon, source) has
    and no cluster, singles are made: for the source `own` one named after the language, for others what is listed (iso,
    canon, source, edition; canon null stands for all).
    """
    testament = F.left("canon", F.lit(2)).alias("testament")
    rows = clusters.where(F.size("ids") > 0).select("iso", testament, F.posexplode("ids").alias("n", "key"), F.get("ids", F.lit(0)).alias("first"), F.coalesce("reachable", F.lit(True)).alias("fetchable"), "likely", "closest")
    found = rows.select("iso", "testament", "key", F.when(F.col("n") > 0, F.col("first")).alias("anchor"), "fetchable", "likely", "closest")
    missing = index.select("iso", testament, "source").distinct().join(rows.select("iso", "testament").distinct(), ["iso", "testament"], "left_anti")
    named = missing.where(F.col("source") == own).select("iso", "testament", F.concat(F.lit(own + ":"), F.upper("iso"), F.upper(F.lit(own))).alias("key"))
    known = listed.where(F.col("source") != own).select("iso", "source", "edition", F.left("canon", F.lit(2)).alias("of")).distinct()
    singles = missing.join(known, ["iso", "source"]).where(F.coalesce(F.col("of") == F.col("testament"), F.lit(True))).select("iso", "testament", F.concat_ws(":", "source", "edition").alias("key")).distinct()
    none = F.lit(None).cast("string")
    made = named.union(singles).select("*", none.alias("anchor"), F.lit(True).alias("fetchable"), none.alias("likely"), none.alias("closest"))
    return found.union(made).select("iso", "testament", "key", F.substring_index("key", ":", 1).alias("source"), F.expr("substring(key, instr(key, ':') + 1)").alias("edition"), "anchor", "fetchable", "likely", "closest")


def families(versions: DataFrame) -> DataFrame:
    """iso, key, source, edition and root of the fetchable editions of catalog_versions().

    An edition is of another's text if either testament says so (the first one that does counts); such links are followed to
    their end, which need not be an edition that is there; editions that point at each other in a circle stand for themselves.
    """
    have = versions.where("fetchable")
    link = have.groupBy("iso", "key").agg(F.first("source").alias("source"), F.first("edition").alias("edition"), F.min_by("anchor", F.when(F.col("anchor").isNotNull(), F.struct("testament", "anchor"))).alias("parent"))
    ids = link.select(F.struct("iso", "key").alias("id"), F.when(F.col("parent").isNotNull(), F.struct("iso", F.col("parent").alias("key"))).alias("parent"))
    outer = ids.where("parent IS NOT NULL").select(F.col("parent").alias("id")).distinct().join(ids.select("id"), "id", "left_anti").select("id", F.lit(None).cast(ids.schema["parent"].dataType).alias("parent"))
    root = roots(ids.union(outer), cut=True).select(F.col("id.iso").alias("iso"), F.col("id.key").alias("key"), F.col("root.key").alias("root"))
    return link.drop("parent").join(root, ["iso", "key"])


def drop_like(editions: DataFrame, verdicts: DataFrame, order: list[str], group: str = "iso") -> DataFrame:
    """Editions without those that a verdict makes redundant, as if keys were visited in order, one by one.

    editions: group, key, source; verdicts: group, key, nth, likely, closest. A key that is still there takes its first redundant
    verdict on an edition that is still there; of the two the one whose source stands first in `order` stays, of equals the
    other. That is solved in rounds: a key is decided once no smaller undecided key could still drop it or an edition that its
    verdict needs, so rounds are as many as the longest chain of such needs. A drop counts for greater keys only.
    """
    rank = F.coalesce(*(F.when(F.col("source") == s, k) for k, s in enumerate(order)), F.lit(len(order))).alias("rank")
    nodes = editions.select(F.col(group).alias("g"), F.col("key"), rank)
    other = nodes.select("g", F.col("key").alias("c"), F.col("rank").alias("c_rank"))
    said = verdicts.where(F.col("likely").isin(*REDUNDANT)).select(F.col(group).alias("g"), "key", "nth", F.col("closest").alias("c"))
    edges = written(said.join(nodes, ["g", "key"]).join(other, ["g", "c"]).select("g", "key", "nth", "c", (F.col("rank") < F.col("c_rank")).alias("strong")), "verdicts")
    begin = nodes.select("g", "key").join(edges.select("g", "key", F.lit(True).alias("open")).distinct(), ["g", "key"], "left").select("g", "key", F.coalesce("open", F.lit(False)).alias("open"), F.lit(None).cast(nodes.schema["key"].dataType).alias("gone"))
    state = written(begin, "editions")
    while state.where("open").limit(1).count():
        undecided = edges.join(state.where("open").select("g", "key", F.col("gone").alias("own_gone")), ["g", "key"])
        least = undecided.where("strong").groupBy("g", "c").agg(F.min("key").alias("least"))
        at = undecided.join(state.select("g", F.col("key").alias("c"), F.col("open").alias("c_open"), F.col("gone").alias("c_gone")), ["g", "c"]).join(least, ["g", "c"], "left")
        waits = F.coalesce(F.col("least") < F.col("key"), F.lit(False)) | (F.col("c_open") & (F.col("c") < F.col("key")))
        there = ~F.coalesce(F.col("c_gone") < F.col("key"), F.lit(False))
        first = F.min(F.when(there, F.struct("nth", waits.alias("waits"), "c", "strong"))).alias("v")
        keys = at.groupBy("g", "key").agg(first, F.first("own_gone").alias("own_gone")).join(least.select("g", F.col("c").alias("key"), F.col("least").alias("own_least")), ["g", "key"], "left")
        dead = F.coalesce(F.col("own_gone") < F.col("key"), F.lit(False))
        sure = dead | (~F.coalesce(F.col("own_least") < F.col("key"), F.lit(False)) & ~F.coalesce(F.col("v.waits"), F.lit(False)))
        done = written(keys.where(sure).select("g", "key", F.when(~dead & F.col("v").isNotNull(), F.when(F.col("v.strong"), F.col("v.c")).otherwise(F.col("key"))).alias("drops")), "decided")
        drops = done.where("drops IS NOT NULL").groupBy("g", F.col("drops").alias("key")).agg(F.min("key").alias("by"))
        new = state.join(done.select("g", "key", F.lit(True).alias("done")), ["g", "key"], "left").join(drops, ["g", "key"], "left")
        new = written(new.select("g", "key", (F.col("open") & F.col("done").isNull()).alias("open"), F.least("gone", "by").alias("gone")), "editions")
        release(state)
        release(done)
        state = new
    return editions.join(state.where("gone IS NOT NULL").select(F.col("g").alias(group), "key"), [group, "key"], "left_anti")


def editions_for(versions: DataFrame, order: list[str]) -> DataFrame:
    """iso, key, source, edition of what to take: one of each family of equal texts, without near copies."""
    picked = preferred(families(versions), ["iso", "root"], "source", order, "key").drop("root")
    nth = F.when(F.col("testament") == "nt", 0).otherwise(1)
    verdicts = versions.where("fetchable AND likely IS NOT NULL").select("iso", "key", nth.alias("nth"), "likely", "closest")
    return drop_like(picked, verdicts, order)


def resolve_iso(tags: DataFrame, manifest: DataFrame, legacy: DataFrame) -> DataFrame:
    """tag and iso: by the manifest, else the legacy map, else the first three letters where the tag begins so."""
    m, l = manifest.select("tag", F.col("iso").alias("__m")), legacy.select("tag", F.col("iso").alias("__l"))
    prefix = F.nullif(F.regexp_extract("tag", "^([a-z]{3})(?:_|$)", 1), F.lit(""))
    return tags.join(m, "tag", "left").join(l, "tag", "left").select("tag", F.coalesce("__m", "__l", prefix).alias("iso"))


def safe_to_clean(tags: DataFrame, *published: DataFrame) -> DataFrame:
    """Resolved tags whose iso is in every published dataset."""
    out = tags.where("iso is not null")
    for p in published:
        out = out.join(p.select("iso").distinct(), "iso", "left_semi")
    return out


def is_stale(pairs_time, output_time, priors_time):
    """Whether an output is missing or older than its pairs or priors."""
    return output_time.isNull() | (output_time < pairs_time) | (output_time < priors_time)
