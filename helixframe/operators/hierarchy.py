"""Gene - transcript - protein navigation and the feature tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from helixframe import terms
from helixframe.functions.expr import spread_null
from helixframe.operators import lookups
from helixframe.session import cut_lineage
from helixframe.tables import Tables


def with_kind(t: Tables, features: DataFrame) -> DataFrame:
    """Add ``kind``: gene, transcript, protein or null, from the feature's type name."""
    groups = {"gene": terms.GENE_TYPES, "transcript": terms.TRANSCRIPT_TYPES, "protein": terms.PROTEIN_TYPES}
    lowered = F.lower("name")
    kind = F.lit(None).cast("string")
    for label, names in groups.items():
        rows = t["cvterm"].where(lowered.isin(names))
        kind = F.when(F.col("type_id").isin(t.ids("cvterm", ("kind", label), rows)), label).otherwise(kind)
    return features.withColumn("kind", kind)


def _first(t: Tables, relationship: str, key: str, pick: str) -> DataFrame:
    """For every ``key`` of the relationship, the ``pick`` feature first by uniquename."""
    edges = t.of_terms(
        t["feature_relationship"].select("subject_id", "object_id", "type_id"), "type_id", [relationship],
        terms.PARENT_CV[relationship],
    ).select(F.col(key).alias("_key"), F.col(pick).alias("_pick"))
    names = t["feature"].select(F.col("feature_id").alias("_pick"), F.col("uniquename").alias("_name"))
    best = F.min(F.struct("_name", "_pick"))
    return edges.join(names, "_pick").groupBy("_key").agg(best["_pick"].alias("_found"))


def _follow(df: DataFrame, hop: Column, first: DataFrame, name: str) -> DataFrame:
    """Left join the first relative of ``hop`` as ``name``."""
    keyed = df.withColumn("_hop", spread_null(hop, F.col("feature_id")))
    found = first.select(F.col("_key").alias("_hop"), F.col("_found").alias(name))
    return keyed.join(found, "_hop", "left").drop("_hop")


def gene_of(t: Tables, features: DataFrame) -> DataFrame:
    """Add ``gene_id`` for features with feature_id and kind (null if there is none)."""
    kind, own = F.col("kind"), F.col("feature_id")
    up = _follow(features, F.when(kind == "protein", own), _first(t, "derives_from", "subject_id", "object_id"), "_up")
    hop = F.when(kind == "transcript", own).when(kind == "protein", F.col("_up"))
    top = _follow(up, hop, _first(t, "part_of", "subject_id", "object_id"), "_top")
    return top.withColumn("gene_id", F.when(kind == "gene", own).otherwise(F.col("_top"))).drop("_up", "_top")


def transcript_of(t: Tables, features: DataFrame) -> DataFrame:
    """Add ``transcript_id``."""
    kind, own = F.col("kind"), F.col("feature_id")
    up = _follow(features, F.when(kind == "protein", own), _first(t, "derives_from", "subject_id", "object_id"), "_up")
    down = _follow(up, F.when(kind == "gene", own), _first(t, "part_of", "object_id", "subject_id"), "_down")
    found = F.when(kind == "transcript", own).when(kind == "protein", F.col("_up")).otherwise(F.col("_down"))
    return down.withColumn("transcript_id", found).drop("_up", "_down")


def protein_of(t: Tables, features: DataFrame) -> DataFrame:
    """Add ``protein_id``."""
    kind, own = F.col("kind"), F.col("feature_id")
    mid = _follow(features, F.when(kind == "gene", own), _first(t, "part_of", "object_id", "subject_id"), "_mid")
    hop = F.when(kind == "transcript", own).when(kind == "gene", F.col("_mid"))
    low = _follow(mid, hop, _first(t, "derives_from", "object_id", "subject_id"), "_low")
    return low.withColumn("protein_id", F.when(kind == "protein", own).otherwise(F.col("_low"))).drop("_mid", "_low")


LEVELS = {"gene": (gene_of, "gene_id"), "transcript": (transcript_of, "transcript_id"), "protein": (protein_of, "protein_id")}


def at_level(t: Tables, features: DataFrame, level: str = "default") -> DataFrame:
    """Add ``target_id``: the relative at the level, or the feature itself."""
    if level not in LEVELS:
        return features.withColumn("target_id", F.col("feature_id"))
    follow, name = LEVELS[level]
    out = follow(t, features)
    return out.withColumn("target_id", F.coalesce(name, "feature_id")).drop(name)


def _placed_edges(t: Tables) -> DataFrame:
    """subject_id, object_id and place of the part_of (0) and derives_from (1) edges, each once and beside its subject's."""
    edges = t["feature_relationship"].select("subject_id", "object_id", "type_id")
    parts = [
        t.of_terms(edges, "type_id", [name], terms.PARENT_CV[name]).select("subject_id", "object_id", F.lit(i).alias("place"))
        for i, name in enumerate(terms.PARENT_TYPES)
    ]
    return parts[0].unionByName(parts[1]).repartition("subject_id").distinct()


def _relationship(place: Column) -> Column:
    return F.when(place == 0, terms.PARENT_TYPES[0]).otherwise(terms.PARENT_TYPES[1])


def parent_edges(t: Tables) -> DataFrame:
    """part_of and derives_from edges with their place among siblings (0 before 1)."""
    return _placed_edges(t).select("subject_id", "object_id", _relationship(F.col("place")).alias("relationship"), "place")


def parent_of(path: Column) -> tuple[Column, Column]:
    """Name of the parent on a path and the relationship to it; null for a sequence or a root."""
    parent = F.get(path, F.size(path) - 2)
    return parent["name"], F.when(parent.isNotNull(), _relationship(F.element_at(path, -1)["place"]))


def _family(t: Tables) -> DataFrame:
    """Every feature beside each of its edges (``place`` is null without one), and whether it is a parent itself.

    Features, edges and parents meet by the feature in one stage and are written: the roots and the children of every
    level are read from here.
    """
    names = t["feature"].select("feature_id", "uniquename", "is_obsolete")
    edges = _placed_edges(t).withColumnRenamed("subject_id", "feature_id")
    parents = t["feature_relationship"].select(F.col("object_id").alias("feature_id"), "type_id")
    parents = reduce(DataFrame.unionByName, [t.of_terms(parents, "type_id", [n], terms.PARENT_CV[n]) for n in terms.PARENT_TYPES])
    parents = parents.select("feature_id").distinct().withColumn("_parent", F.lit(True))
    met = names.join(edges, "feature_id", "left").join(parents, "feature_id", "left")
    return cut_lineage(met.withColumn("_parent", F.coalesce("_parent", F.lit(False))))


def roots(t: Tables) -> DataFrame:
    """Features without a part_of or derives_from parent."""
    held = parent_edges(t).select(F.col("subject_id").alias("feature_id"))
    return t["feature"].join(held, "feature_id", "left_anti")


class CircularTree(ValueError):
    """A feature is its own ancestor."""


def tree(t: Tables, organism: str | None = None, include_obsolete: bool = False) -> DataFrame:
    """Pre-order walk of the features of each top-level sequence.

    Columns: sequence, feature_id, parent, relationship, depth, path. Sorting by
    (sequence, path) gives the walk: the sequence itself and its children, then
    the root features by start, below each its part_of children by name, then
    its derives_from children. A child with two parents appears below each.
    Obsolete roots are kept on request; obsolete children never are. Depth is
    not limited; a feature that lies below itself raises CircularTree.
    """
    flagged = lookups.features_with_property(t, terms.TOP_LEVEL).select("feature_id", "organism_id", "uniquename")
    top = t.of_names(flagged, "organism_id", "organism", [organism]) if organism else flagged
    top = cut_lineage(top.drop("organism_id"))
    family = _family(t)
    step = lambda place, start, name, fid: F.struct(
        place.cast("int").alias("place"), F.coalesce(start.cast("long"), F.lit(2**62)).alias("start"), name.alias("name"), fid.alias("id")
    )
    nothing = F.lit(None).cast("string")
    level = top.select(
        F.col("uniquename").alias("sequence"), F.col("feature_id").alias("sequence_id"), "feature_id",
        F.col("uniquename").alias("name"), nothing.alias("parent"), nothing.alias("relationship"),
        F.array(step(F.lit(0), F.lit(0), F.col("uniquename"), F.col("feature_id"))).alias("path"), F.lit(True).alias("_parent"),
    )
    # Entities once: several locations on a sequence give the first start, several edges one.
    placed = t["featureloc"].select("feature_id", "srcfeature_id", "fmin").repartition("feature_id")
    located = placed.groupBy("feature_id", "srcfeature_id").agg(F.min("fmin").alias("fmin"))
    root = family.where(F.col("place").isNull())
    if not include_obsolete:
        root = root.where(~F.col("is_obsolete"))
    root = root.join(located, "feature_id").join(
        top.select(F.col("feature_id").alias("srcfeature_id"), F.col("uniquename").alias("sequence")), "srcfeature_id"
    )
    level = level.unionByName(root.select(
        "sequence", F.col("srcfeature_id").alias("sequence_id"), "feature_id", F.col("uniquename").alias("name"),
        nothing.alias("parent"), nothing.alias("relationship"),
        F.array(step(F.lit(1), F.col("fmin"), F.col("uniquename"), F.col("feature_id"))).alias("path"), "_parent",
    ))
    kids = family.where(F.col("object_id").isNotNull() & ~F.col("is_obsolete")).select(
        "object_id", F.col("feature_id").alias("subject_id"), F.col("uniquename").alias("child"), "place", "_parent")
    found = []
    level = cut_lineage(level.withColumn("depth", F.lit(0)))
    found.append(level.drop("_parent"))
    # Rows without children go no further, so the last level is not joined again.
    while not (level := level.where("_parent")).isEmpty():
        up = level.select(
            "sequence", "sequence_id", F.col("feature_id").alias("object_id"), "path", "depth",
        )
        below = up.join(kids, "object_id").withColumn("_again", F.exists("path", lambda s: s["id"] == F.col("subject_id")))
        level = cut_lineage(below.select(
            "sequence", "sequence_id", F.col("subject_id").alias("feature_id"), F.col("child").alias("name"),
            F.element_at("path", -1)["name"].alias("parent"), _relationship(F.col("place")).alias("relationship"),
            F.concat("path", F.array(step(F.col("place"), F.lit(0), F.col("child"), F.col("subject_id")))).alias("path"),
            (F.col("depth") + 1).alias("depth"), "_again", "_parent",
        ))
        circle = level.where("_again").first()
        if circle:
            raise CircularTree(f"feature '{circle['name']}' lies below itself")
        found.append(level.drop("_again", "_parent"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out
