"""Export of sequences: contigs, genes and proteins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe import terms
from helixframe.functions.expr import reverse_complement, url_quote
from helixframe.operators import lookups, merge
from helixframe.sinks.delimited import write_text
from helixframe.sources.fasta import PIECE
from helixframe.tables import Tables

CHUNK = 10_000
LINE = 60


def sequence_chunks(features: DataFrame, width: int = CHUNK) -> DataFrame:
    """Residues in pieces of fixed width: srcfeature_id, chunk_no, bases.

    The sequence is cut in one pass; only pieces travel in the joins.
    """
    pieces = F.regexp_extract_all("residues", F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    return features.select(F.col("feature_id").alias("srcfeature_id"), F.posexplode(pieces).alias("chunk_no", "bases"))


def gene_sequences(t: Tables, genes: DataFrame, sources: DataFrame, strict_end: bool = True, width: int = CHUNK) -> DataFrame:
    """Nucleotides of located genes, reverse-complemented on the minus strand: feature_id, residues.

    Each gene meets only the pieces it overlaps. With ``strict_end`` a gene
    that ends at the last base of its sequence is left out.
    """
    length = sources.select(F.col("feature_id").alias("srcfeature_id"), F.length("residues").alias("_length"))
    return _cut_genes(t, genes, sequence_chunks(sources, width), length, strict_end, width)


def gene_sequences_of_pieces(
    t: Tables, genes: DataFrame, pieces: DataFrame, strict_end: bool = True, width: int = PIECE
) -> DataFrame:
    """As ``gene_sequences``, from pieces (srcfeature_id, chunk_no, bases) instead of whole residues."""
    length = pieces.groupBy("srcfeature_id").agg(F.sum(F.length("bases")).alias("_length"))
    return _cut_genes(t, genes, pieces, length, strict_end, width)


def _cut_genes(t: Tables, genes: DataFrame, pieces: DataFrame, length: DataFrame, strict_end: bool, width: int) -> DataFrame:
    # Locations meet the genes before they are grouped: one exchange, and no sort before it.
    loc = t["featureloc"].join(genes.select("feature_id"), "feature_id", "left_semi").groupBy("feature_id").agg(
        F.min_by(F.struct("srcfeature_id", "fmin", "fmax", "strand"), "featureloc_id").alias("l")
    ).select("feature_id", "l.*")
    spare = 1 if strict_end else 0
    placed = genes.select("feature_id").join(loc, "feature_id").join(length, "srcfeature_id").where(
        (F.col("_length") >= F.col("fmax") + spare) & (F.col("fmax") > F.col("fmin"))
    )
    spans = placed.select(
        "feature_id", "srcfeature_id", "fmin", "fmax", "strand",
        F.explode(F.expr(f"sequence(cast(fmin div {width} AS int), cast((fmax - 1) div {width} AS int))")).alias("chunk_no"),
    )
    start = F.greatest(F.col("fmin") - F.col("chunk_no") * width, F.lit(0))
    stop = F.least(F.col("fmax") - F.col("chunk_no") * width, F.lit(width))
    cut = spans.join(pieces, ["srcfeature_id", "chunk_no"]).select(
        "feature_id", "strand", "chunk_no", F.upper(F.substring("bases", (start + 1).cast("int"), (stop - start).cast("int"))).alias("part")
    )
    joined = cut.groupBy("feature_id", "strand").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "part"))).alias("p"))
    bases = F.array_join(F.transform("p", lambda x: x["part"]), "")
    return joined.select("feature_id", F.when(F.col("strand") < 0, reverse_complement(bases)).otherwise(bases).alias("residues"))


def valid_residues(residues: Column, kind: str) -> Column:
    pattern = terms.PROTEIN_PATTERN if kind == "proteins" else terms.NUCLEOTIDE_PATTERN
    return F.coalesce(F.rlike(residues, F.lit(pattern)), F.lit(False))


def fasta_records(
    t: Tables, kind: str, organism: str | None = None, release: str = "", include_obsolete: bool = False,
    strict_end: bool = True, pieces: DataFrame | None = None,
) -> DataFrame:
    """Sequences of one kind (contigs, genes, proteins): organism, id, description, residues.

    Genes are cut from the residues of their sequences, or from ``pieces`` (``pieces_of_features``) where these are given.
    """
    if kind == "proteins":
        features = lookups.protein_features(t)
    elif kind == "genes":
        features = lookups.features_by_type(t, ["gene"], terms.SEQUENCE_CV)
    else:
        features = lookups.features_with_property(t, terms.TOP_LEVEL)
    if organism:
        features = t.of_names(features, "organism_id", "organism", [organism])
    if not include_obsolete:
        features = features.where(~F.col("is_obsolete"))
    if kind == "genes":
        sources = lookups.features_with_property(t, terms.TOP_LEVEL)
        if organism:
            sources = t.of_names(sources, "organism_id", "organism", [organism])
        if pieces is None:
            cut = gene_sequences(t, features, sources.where(F.col("residues").isNotNull()), strict_end)
        else:
            own = pieces.join(sources.select(F.col("feature_id").alias("srcfeature_id")), "srcfeature_id", "left_semi")
            cut = gene_sequences_of_pieces(t, features, own, strict_end)
        features = features.drop("residues").join(cut, "feature_id")
    features = features.where(valid_residues(F.col("residues"), kind))
    return described(t, features, release).select("organism", "id", "description", "residues")


def described(t: Tables, features: DataFrame, release: str = "") -> DataFrame:
    """Features with organism, id and description of their header line."""
    type_names = t.term_names("feature", "type")
    version = t["organismprop"].where(F.col("type_id") == t.term_id("version")).groupBy("organism_id").agg(
        F.min_by("value", "organismprop_id").alias("version")
    )
    org = t["organism"].select(
        "organism_id", F.col("abbreviation").alias("organism"),
        F.concat_ws(" ", "genus", "species", F.when(F.col("infraspecific_name") != "", F.col("infraspecific_name"))).alias("organism_name"),
    ).join(version, "organism_id", "left")
    pair = lambda key, text: F.when(text != "", F.concat(F.lit(f"{key}="), url_quote(text)))
    description = F.concat(F.lit("| "), F.concat_ws(
        " | ", pair("organism", F.col("organism_name")), pair("sequence_type", F.col("type")),
        pair("sequence_name", F.col("name")), pair("genome_version", F.col("version")), pair("release", F.lit(release)),
    ))
    return features.join(type_names, "type_id").join(org, "organism_id").withColumns(
        {"id": F.col("uniquename"), "description": description})


def pieces_of_features(t: Tables, records: DataFrame, pieces: DataFrame) -> DataFrame:
    """Pieces of a sequence file by feature: srcfeature_id, chunk_no, bases.

    ``records`` (organism_id, id, pos) belong to the features of that name; of records with one id the last counts.
    """
    last = merge.last_rows(records.select("organism_id", "id", "pos", F.col("pos").alias("of")), ["organism_id", "id"], "pos")
    held = t["feature"].select("organism_id", F.col("uniquename").alias("id"), F.col("feature_id").alias("srcfeature_id"))
    return pieces.join(last.join(held, ["organism_id", "id"]).select(F.col("of").alias("pos"), "srcfeature_id"), "pos").drop("pos")


def write_pieces(t: Tables, path: str, features: DataFrame, pieces: DataFrame, release: str = "", compress: bool = False) -> None:
    """Write sequences from their pieces, sorted by id; a row holds one piece, so a sequence may span several part files."""
    wrapped = F.regexp_replace("bases", f"(.{{{LINE}}})(?=.)", "$1\n")
    names = described(t, features, release).select("feature_id", "id", "description")
    heads = names.select("id", F.lit(-1).alias("chunk_no"), F.concat(F.lit(">"), "id", F.lit(" "), "description").alias("value"))
    body = pieces.join(names.select(F.col("feature_id").alias("srcfeature_id"), "id"), "srcfeature_id").select("id", "chunk_no", wrapped.alias("value"))
    write_text(heads.unionByName(body).orderBy("id", "chunk_no").select("value"), path, compress)


def fasta_text() -> Column:
    """A record as text: header line and wrapped residues."""
    wrapped = F.regexp_replace("residues", f"(.{{{LINE}}})(?=.)", "$1\n")
    return F.concat(F.lit(">"), F.col("id"), F.lit(" "), F.col("description"), F.lit("\n"), wrapped)


def write_fasta(
    t: Tables, path: str, kind: str, organism: str, release: str = "", include_obsolete: bool = False,
    strict_end: bool = True, compress: bool = False,
) -> None:
    """Write the sequences of an organism sorted by id."""
    records = fasta_records(t, kind, organism, release, include_obsolete, strict_end)
    write_text(records.orderBy("id").select(fasta_text().alias("value")), path, compress)
