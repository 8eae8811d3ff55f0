"""Ontology files: OBO stanzas and OWL classes as the same term records.

Term columns: id, name, namespace, definition, comment, is_obsolete, synonyms
(array of text and scope), xrefs, alt_ids, relations (array of type and object).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from helixframe.sources.fasta import with_header

TERM_COLUMNS = [
    "id", "name", "namespace", "definition", "comment", "is_obsolete", "synonyms", "xrefs", "alt_ids", "relations",
]


def read_stanzas(spark: SparkSession, path: str) -> DataFrame:
    """Stanzas, each from its ``[`` line to the next: kind (header, Term, Typedef) and (tag, value) lines.

    Only a stanza begins a line with a bracket, so neither blank lines nor line
    ends matter.
    """
    raw = spark.read.option("lineSep", "\n[").text(path)
    text = F.trim(F.regexp_replace(F.translate("value", "\r", ""), r"(?m)[ \t]+$", ""), F.lit("\n"))
    rows = raw.select(text.alias("text")).where(F.col("text") != "")
    name = F.regexp_extract("text", r"^\[?(\w+)\]", 1)
    kind = F.when(name != "", name).otherwise("header")
    pairs = F.transform(
        F.filter(F.split("text", "\n"), lambda line: F.contains(line, F.lit(": "))),
        lambda line: F.struct(
            F.substring_index(line, ": ", 1).alias("tag"), F.regexp_replace(line, "^[^:]*: ", "").alias("value")
        ),
    )
    return rows.select(kind.alias("kind"), pairs.alias("tags"))


def _values(tag: str) -> Column:
    return F.transform(F.filter("tags", lambda t: t["tag"] == tag), lambda t: t["value"])


def _first(tag: str) -> Column:
    return F.get(_values(tag), F.lit(0))


def _quoted(text: Column) -> Column:
    """Text between the first pair of quotes, backslash escapes resolved."""
    return F.regexp_replace(F.regexp_extract(text, r'^"((?:[^"\\]|\\.)*)"', 1), r"\\(.)", "$1")


def default_namespace(stanzas: DataFrame) -> str:
    """The default namespace of the header, empty if there is none."""
    row = stanzas.where(F.col("kind") == "header").select(_first("default-namespace").alias("n")).where(
        F.col("n").isNotNull()
    ).first()
    return row["n"] if row else ""


def obo_terms(stanzas: DataFrame) -> DataFrame:
    """Term records of OBO stanzas."""
    bare = lambda text: F.trim(F.regexp_replace(text, r"\s*(\{.*\})?\s*(!.*)?$", ""))
    synonym = lambda s: F.struct(
        _quoted(s).alias("text"), F.lower(F.regexp_extract(s, r'^"(?:[^"\\]|\\.)*"\s+(\w+)', 1)).alias("scope")
    )
    is_a = F.transform(_values("is_a"), lambda v: F.struct(F.lit("is_a").alias("type"), bare(v).alias("object")))
    other = F.transform(
        _values("relationship"),
        lambda v: F.struct(F.substring_index(v, " ", 1).alias("type"),
                           bare(F.regexp_replace(v, r"^\S+\s+", "")).alias("object")),
    )
    return stanzas.where(F.col("kind") == "Term").select(
        F.trim(_first("id")).alias("id"), _first("name").alias("name"), _first("namespace").alias("namespace"),
        F.when(_quoted(_first("def")) != "", _quoted(_first("def"))).alias("definition"),
        _first("comment").alias("comment"),
        F.coalesce(F.lower(_first("is_obsolete")) == "true", F.lit(False)).alias("is_obsolete"),
        F.transform(_values("synonym"), synonym).alias("synonyms"),
        F.transform(_values("xref"), lambda v: F.substring_index(v, " ", 1)).alias("xrefs"),
        F.transform(_values("alt_id"), bare).alias("alt_ids"),
        F.concat(is_a, other).alias("relations"),
    )


def obo_typedefs(stanzas: DataFrame) -> DataFrame:
    """Relationship types declared in the file, by id."""
    return stanzas.where(F.col("kind") == "Typedef").select(F.trim(_first("id")).alias("name"))


def of_authority(terms: DataFrame, authority: str) -> DataFrame:
    """Terms whose id starts with the authority."""
    return terms.where(F.substring_index("id", ":", 1) == authority)


def read_obo(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, str]:
    """(terms, typedefs, default namespace) of an OBO file."""
    stanzas = read_stanzas(spark, path)
    return obo_terms(stanzas), obo_typedefs(stanzas), default_namespace(stanzas)


_TEXT = "STRUCT<_VALUE: STRING>"
_RESOURCE = "STRUCT<`_rdf:resource`: STRING>"
OWL_CLASS = f"""`_rdf:about` STRING, `_rdf:ID` STRING, `rdf:type` ARRAY<{_RESOURCE}>, `rdfs:label` ARRAY<{_TEXT}>, `obo:IAO_0000115` ARRAY<{_TEXT}>,
 `rdfs:comment` ARRAY<{_TEXT}>, `owl:deprecated` {_TEXT}, `oboInOwl:hasOBONamespace` ARRAY<{_TEXT}>,
 `oboInOwl:hasExactSynonym` ARRAY<{_TEXT}>, `oboInOwl:hasNarrowSynonym` ARRAY<{_TEXT}>,
 `oboInOwl:hasBroadSynonym` ARRAY<{_TEXT}>, `oboInOwl:hasRelatedSynonym` ARRAY<{_TEXT}>,
 `oboInOwl:hasDbXref` ARRAY<{_TEXT}>, `oboInOwl:hasAlternativeId` ARRAY<{_TEXT}>,
 `rdfs:subClassOf` ARRAY<STRUCT<`_rdf:resource`: STRING, `owl:Class`: STRUCT<`_rdf:about`: STRING>, `owl:Restriction`: STRUCT<
   `owl:onProperty`: {_RESOURCE}, `owl:someValuesFrom`: {_RESOURCE}>>>"""


def _local_id(iri: Column) -> Column:
    """``.../GO_0000001`` as ``GO:0000001``; a property keeps its fragment name."""
    return F.regexp_replace(F.regexp_replace(iri, "^.*[/#]", ""), "_(?=[0-9]+$)", ":")


# Namespaces of OWL files by the prefix that is used for them here.
NAMESPACES = {
    "owl": "http://www.w3.org/2002/07/owl#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "obo": "http://purl.obolibrary.org/obo/",
    "oboInOwl": "http://www.geneontology.org/formats/oboInOwl#",
}
# A tag up to its end; quoted attribute values may hold ">".
TAG = r"""^((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""


def _opaque(tags: DataFrame) -> DataFrame:
    """Add ``_opaque``: "comment" or "data" for what lies in a comment or CDATA section, tags included, else ""."""
    value = F.col("value")
    opens = F.when(F.startswith(value, F.lit("!--")), "comment").when(F.startswith(value, F.lit("![CDATA[")), "data")
    closes = F.contains(value, F.lit("-->")) | F.contains(value, F.lit("]]>"))
    mark = F.when(closes, F.lit("")).otherwise(opens)
    marked = with_header(tags, F.when(mark.isNotNull(), F.struct("pos", mark.alias("state"))))
    state = F.coalesce(F.col("_record.state"), F.lit(""))
    # The row that ends a section still belongs to it: what follows the end is text.
    inside = F.when(state != "", state).when(F.startswith(value, F.lit("!--")), "comment").when(closes & F.contains(value, F.lit("-->")), "comment")
    return marked.withColumn("_opaque", F.coalesce(inside.when(closes, "data"), F.lit(""))).drop("_head", "_record", "_file", "_block")


def owl_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements below the root, if there is one, of OWL (RDF/XML) files: kind (``owl:Class`` ...), xml.

    Each tag with the text behind it is a row, so a file is read by many tasks, however it is laid out. The depth of a tag
    is the sum of the tags before it that open or close an element: within its split by a window, plus the sums of the
    splits before. Prefixes and entities that the file declares are written as those of ``NAMESPACES``. Comments are left out.
    An element is one row; elements without content of their own carry no data and are left out.
    """
    raw = spark.read.option("lineSep", "<").text(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    tags = _opaque(raw.select("value", place.alias("pos")).where(F.trim("value") != "")).where("_opaque <> 'comment'")
    body = F.regexp_extract("value", TAG, 1)
    tags = tags.withColumn("value", F.when(F.col("_opaque") == "", _canonical(body, raw)).otherwise(F.col("value")))
    turn = F.when(F.rlike("value", F.lit(r"^([?!]|/?rdf:RDF[\s>])")) | (F.col("_opaque") != ""), 0).when(F.startswith("value", F.lit("/")), -1).when(
        F.endswith(body, F.lit("/")), 0).otherwise(1)
    rows = tags.withColumns({"_turn": turn, "_file": F.col("pos.file"), "_block": F.col("pos.block")})
    sums = rows.groupBy("_file", "_block").agg(F.sum("_turn").alias("_sum"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_file", "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_file", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    deep = rows.withColumn("_within", F.coalesce(F.sum("_turn").over(within), F.lit(0))).join(sums, ["_file", "_block"])
    deep = deep.select("pos", "value", "_turn", (F.col("_within") + F.col("_before")).alias("_depth"))
    starts = (F.col("_depth") == 0) & (F.col("_turn") == 1)
    owned = with_header(deep.where("_depth > 0 OR _turn = 1"), F.when(starts, F.col("pos")))
    grouped = owned.where(F.col("_record").isNotNull()).groupBy("_record").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("t"))
    text = F.trim(F.concat(F.lit("<"), F.array_join(F.transform("t", lambda x: x["value"]), "<")), F.lit(" \r\n\t"))
    found = grouped.select(text.alias("xml"))
    return found.select(F.regexp_extract("xml", r"^<([^\s/>]+)", 1).alias("kind"), "xml")


def _canonical(body: Column, raw: DataFrame) -> Column:
    """A row of a tag (``body``) and text with the file's own prefixes and entities replaced: as many as its header declares."""
    text = F.substring("value", F.length(body) + 1, F.length("value"))
    entities = raw.where(F.startswith("value", F.lit("!ENTITY"))).select(
        F.regexp_extract("value", "^!ENTITY\\s+(\\S+)\\s+[\"']([^\"']*)", 1).alias("name"),
        F.regexp_extract("value", "^!ENTITY\\s+(\\S+)\\s+[\"']([^\"']*)", 2).alias("text")).distinct().collect()
    whole = {e["name"]: e["text"] for e in entities}
    for name, stands in whole.items():
        body, text = (F.replace(x, F.lit(f"&{name};"), F.lit(stands)) for x in (body, text))
    pattern = F.lit(r"""xmlns(?::([\w.-]+))?\s*=\s*["']([^"']*)""")
    declared = raw.where(F.rlike("value", F.lit(r"^(?:[\w.-]+:)?RDF\s"))).select(F.explode(F.arrays_zip(
        F.regexp_extract_all("value", pattern, F.lit(1)).alias("p"), F.regexp_extract_all("value", pattern, F.lit(2)).alias("n"))).alias("x"))
    known = {iri: prefix for prefix, iri in NAMESPACES.items()}
    own = {}
    for prefix, iri in declared.select("x.*").distinct().collect():
        for name, stands in whole.items():
            iri = iri.replace(f"&{name};", stands)
        if known.get(iri, prefix) != prefix:
            own[prefix] = known[iri]
    # Marked until all are done, as a file may use a prefix of this list for another namespace.
    for prefix, name in own.items():
        if prefix:
            old = re.escape(prefix)
            body = F.regexp_replace(body, rf"^(/?){old}:", f"$1\u0001{name}:")
            body = F.regexp_replace(body, rf"(?<=\s){old}:(?=[\w.-]+\s*=)", f"\u0001{name}:")
        else:
            body = F.regexp_replace(body, r"^(/?)(?=[\w.-]+(?:[\s/]|$))", f"$1\u0001{name}:")
    return F.translate(F.concat(body, text), "\u0001", "")


def _named(elements: DataFrame, kind: str) -> DataFrame:
    """Parsed elements of a kind with an id: typed ones, or descriptions that name the kind as their type."""
    parsed = elements.where(F.col("kind").isin(kind, "rdf:Description")).select(
        "kind", F.from_xml("xml", OWL_CLASS, {"attributePrefix": "_", "valueTag": "_VALUE"}).alias("c")).select("kind", "c.*")
    stated = F.exists(F.col("`rdf:type`"), lambda x: x["_rdf:resource"] == NAMESPACES["owl"] + kind.removeprefix("owl:"))
    ident = F.coalesce("`_rdf:about`", "`_rdf:ID`")
    return parsed.where(ident.isNotNull() & ((F.col("kind") == kind) | F.coalesce(stated, F.lit(False)))).withColumn("_id", _local_id(ident))


def owl_typedefs(elements: DataFrame) -> DataFrame:
    """Relationship types of an OWL file: its object properties, by id."""
    return _named(elements, "owl:ObjectProperty").select(F.col("_id").alias("name")).distinct()


def read_owl(spark: SparkSession, path: str) -> DataFrame:
    """Term records of the named classes of an OWL (RDF/XML) file."""
    return owl_terms(owl_elements(spark, path))


def owl_terms(elements: DataFrame) -> DataFrame:
    """Term records of the named classes among the elements of an OWL file."""
    raw = _named(elements, "owl:Class")
    texts = lambda name: F.coalesce(
        F.transform(F.col(f"`{name}`"), lambda v: v["_VALUE"]), F.expr("cast(array() AS array<string>)")
    )
    first = lambda name: F.get(texts(name), F.lit(0))
    scoped = lambda scope: lambda v: F.struct(v.alias("text"), F.lit(scope).alias("scope"))
    synonyms = F.concat(*[
        F.transform(texts(f"oboInOwl:has{scope.title()}Synonym"), scoped(scope))
        for scope in ["exact", "narrow", "broad", "related"]
    ])
    relations = F.transform(
        F.coalesce(F.col("`rdfs:subClassOf`"), F.expr("array()").cast(raw.schema["rdfs:subClassOf"].dataType)),
        lambda s: F.when(
            F.coalesce(s["_rdf:resource"], s["owl:Class"]["_rdf:about"]).isNotNull(),
            F.struct(F.lit("is_a").alias("type"), _local_id(F.coalesce(s["_rdf:resource"], s["owl:Class"]["_rdf:about"])).alias("object")),
        ).otherwise(F.struct(
            _local_id(s["owl:Restriction"]["owl:onProperty"]["_rdf:resource"]).alias("type"),
            _local_id(s["owl:Restriction"]["owl:someValuesFrom"]["_rdf:resource"]).alias("object"),
        )),
    )
    return raw.select(
        F.col("_id").alias("id"), first("rdfs:label").alias("name"),
        first("oboInOwl:hasOBONamespace").alias("namespace"), first("obo:IAO_0000115").alias("definition"),
        first("rdfs:comment").alias("comment"),
        F.coalesce(F.lower(F.col("`owl:deprecated`")["_VALUE"]) == "true", F.lit(False)).alias("is_obsolete"),
        synonyms.alias("synonyms"),
        F.transform(texts("oboInOwl:hasDbXref"), lambda v: F.substring_index(v, " ", 1)).alias("xrefs"),
        texts("oboInOwl:hasAlternativeId").alias("alt_ids"), relations.alias("relations"),
    )
