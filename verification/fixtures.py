"""Annotation tables as views over the given star-schema tables.

Every view is one SQL text that Spark and DuckDB both run, so a query and its
check start from the same rows. Orders become genes, line items become
transcripts with one polypeptide each, parts become products and publications,
suppliers become ontology terms, nations become organisms with one chromosome.
``{name}`` stands for a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from helixframe.schema import TABLES
from helixframe.session import partitions_for, scratch_path, tune
from helixframe.tables import Tables

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

VIEWS: dict[str, str] = {}

VIEWS["fx_tx"] = """
SELECT l_orderkey AS o, cast(l_linenumber AS bigint) AS l, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey,
  min(l_returnflag) AS flag, max(l_linestatus) AS status,
  replace(cast(cast(min(l_shipdate) AS date) AS string), '-', '') AS ymd
FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""

VIEWS["fx_gene"] = """
SELECT 1000 + 20 * o_orderkey AS gene_id, o_orderkey AS o, cast(c_nationkey AS bigint) AS n,
  o_orderstatus AS status, o_orderpriority AS priority
FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""

VIEWS["fx_model"] = """
SELECT g.gene_id, g.o, g.n, t.l, g.gene_id + t.l AS tx_id, g.gene_id + 10 + t.l AS pep_id,
  t.partkey, t.suppkey, t.flag, t.status, t.ymd
FROM fx_gene g JOIN fx_tx t ON g.o = t.o"""

VIEWS["cv"] = """
SELECT cast(cv_id AS bigint) AS cv_id, name, cast(NULL AS string) AS definition
FROM (VALUES (1,'sequence'), (2,'relationship'), (3,'feature_property'), (4,'genedb_products'),
  (5,'annotation_change'), (6,'genedb_misc'), (7,'genedb_synonym_type'), (8,'biological_process'),
  (9,'molecular_function'), (10,'cellular_component'), (11,'null'), (12,'synonym_type'),
  (13,'cvterm_property_type'), (14,'gene_ontology')) AS t(cv_id, name)"""

VIEWS["db"] = """
SELECT cast(db_id AS bigint) AS db_id, name, cast(NULL AS string) AS description,
  cast(NULL AS string) AS urlprefix, cast(NULL AS string) AS url
FROM (VALUES (1,'SO'), (2,'RO'), (3,'SOFP'), (4,'PRODUCT'), (5,'internal'), (6,'genedb_misc'), (7,'GO'),
  (8,'Wikidata'), (9,'PMID'), (10,'null'), (11,'UniProtKB'), (12,'EMBL'), (13,'GO_REF'), (14,'MetaCyc'))
  AS t(db_id, name)"""

VIEWS["fx_term"] = """
SELECT cast(id AS bigint) AS id, name, cast(cv AS bigint) AS cv, rel
FROM (VALUES (1,'gene',1,0), (2,'mRNA',1,0), (3,'polypeptide',1,0), (4,'chromosome',1,0), (5,'pseudogene',1,0),
  (6,'CDS',1,0), (7,'derives_from',1,1), (8,'part_of',2,1), (9,'is_a',2,1), (10,'comment',3,0), (11,'score',3,0),
  (12,'source',3,0), (13,'description',3,0), (14,'date',3,0), (15,'top_level_seq',6,0), (16,'evidence',6,0),
  (17,'genedb_public',6,0), (18,'assigned_by',6,0), (19,'version',6,0), (20,'synonym',7,0), (21,'alias',7,0),
  (22,'previous_systematic_id',7,0), (23,'taxonId',6,0), (24,'qualifier',6,0), (25,'curation',6,0),
  (26,'annotation_change',5,0), (27,'null',11,0), (28,'contig',1,0), (29,'supercontig',1,0), (30,'region',1,0),
  (31,'exon',1,0), (32,'intron',1,0), (33,'exact',12,0), (34,'narrow',12,0), (35,'broad',12,0),
  (36,'related',12,0)) AS t(id, name, cv, rel)"""

VIEWS["cvterm"] = """
SELECT id AS cvterm_id, cv AS cv_id, 4 * id AS dbxref_id, name, cast(NULL AS string) AS definition,
  0 AS is_obsolete, rel AS is_relationshiptype FROM fx_term
UNION ALL
SELECT 1000 + 2 * p_partkey, cast(4 AS bigint), 4 * (1000 + 2 * p_partkey),
  p_name || ' ' || p_brand || ' #' || cast(p_partkey AS string), cast(NULL AS string), 0, 0 FROM {part}
UNION ALL
SELECT 1001 + 2 * s_suppkey, 8 + s_suppkey % 3, 4 * (1001 + 2 * s_suppkey), s_name,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'definition of ' || s_name END,
  CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END, 0 FROM {supplier}"""

VIEWS["dbxref"] = """
SELECT 4 * id AS dbxref_id,
  cast(CASE cv WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 11 THEN 10 WHEN 12 THEN 5 ELSE 6 END AS bigint) AS db_id,
  name AS accession, '' AS version, cast(NULL AS string) AS description FROM fx_term
UNION ALL
SELECT 4 * (1000 + 2 * p_partkey), cast(4 AS bigint),
  p_name || ' ' || p_brand || ' #' || cast(p_partkey AS string), '', cast(NULL AS string) FROM {part}
UNION ALL
SELECT 4 * (1001 + 2 * s_suppkey), cast(7 AS bigint), lpad(cast(s_suppkey AS string), 7, '0'), '',
  cast(NULL AS string) FROM {supplier}
UNION ALL
SELECT 4 * cast(n_nationkey AS bigint) + 1, cast(8 AS bigint), 'Q' || cast(n_nationkey AS string), '',
  cast(NULL AS string) FROM {nation}
UNION ALL
SELECT 4 * o + 2, cast(11 AS bigint), 'P' || cast(o AS string), '', cast(NULL AS string) FROM fx_gene
UNION ALL
SELECT DISTINCT 8 * (o % 100) + 3, cast(12 AS bigint), 'E' || cast(o % 100 AS string), '',
  cast(NULL AS string) FROM fx_gene
UNION ALL
SELECT DISTINCT 8 * (1000 + o % 5) + 3, cast(13 AS bigint), '000000' || cast(o % 5 AS string), '',
  cast(NULL AS string) FROM fx_gene
UNION ALL
SELECT 8 * s_suppkey + 7, cast(14 AS bigint), 'M' || cast(s_suppkey AS string), '',
  cast(NULL AS string) FROM {supplier}"""

VIEWS["cvtermprop"] = """
SELECT s_suppkey AS cvtermprop_id, 1001 + 2 * s_suppkey AS cvterm_id, cast(10 AS bigint) AS type_id,
  'comment ' || cast(s_suppkey AS string) AS value, 0 AS rank FROM {supplier} WHERE s_suppkey % 3 = 0"""

VIEWS["cvtermsynonym"] = """
SELECT s_suppkey AS cvtermsynonym_id, 1001 + 2 * s_suppkey AS cvterm_id, s_name || ' syn' AS synonym,
  cast(CASE WHEN s_suppkey % 4 = 0 THEN 33 ELSE 35 END AS bigint) AS type_id FROM {supplier} WHERE s_suppkey % 2 = 0"""

VIEWS["cvterm_dbxref"] = """
SELECT s_suppkey AS cvterm_dbxref_id, 1001 + 2 * s_suppkey AS cvterm_id, 8 * s_suppkey + 7 AS dbxref_id,
  0 AS is_for_definition FROM {supplier} WHERE s_suppkey % 5 = 0"""

VIEWS["cvterm_relationship"] = """
SELECT s_suppkey AS cvterm_relationship_id, cast(9 AS bigint) AS type_id, 1001 + 2 * s_suppkey AS subject_id,
  1001 + (s_suppkey - s_suppkey % 2) AS object_id FROM {supplier} WHERE s_suppkey > 1"""

VIEWS["organism"] = """
SELECT cast(n_nationkey AS bigint) AS organism_id, n_name AS abbreviation, r_name AS genus, lower(n_name) AS species,
  n_name AS common_name,
  CASE WHEN n_nationkey % 2 = 0 THEN 'strain' || cast(n_nationkey AS string) END AS infraspecific_name,
  cast(NULL AS bigint) AS type_id, cast(NULL AS string) AS comment
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

VIEWS["organismprop"] = """
SELECT 3 * cast(n_nationkey AS bigint) AS organismprop_id, cast(n_nationkey AS bigint) AS organism_id,
  cast(19 AS bigint) AS type_id, 'v' || cast(n_nationkey AS string) AS value, 0 AS rank
FROM {nation} WHERE n_nationkey % 2 = 0
UNION ALL
SELECT 3 * cast(n_nationkey AS bigint) + 1, cast(n_nationkey AS bigint), cast(23 AS bigint),
  cast(5800 + n_nationkey AS string), 0 FROM {nation} WHERE n_nationkey % 3 = 0
UNION ALL
SELECT 3 * cast(n_nationkey AS bigint) + 2, cast(n_nationkey AS bigint), cast(17 AS bigint), 'true', 0
FROM {nation} WHERE n_nationkey % 5 < 3"""

VIEWS["organism_dbxref"] = """
SELECT cast(n_nationkey AS bigint) AS organism_dbxref_id, cast(n_nationkey AS bigint) AS organism_id,
  4 * cast(n_nationkey AS bigint) + 1 AS dbxref_id FROM {nation} WHERE n_nationkey % 4 <> 0"""

VIEWS["feature"] = """
SELECT feature_id, cast(NULL AS bigint) AS dbxref_id, organism_id, name, uniquename, residues,
  cast(length(residues) AS bigint) AS seqlen, cast(NULL AS string) AS md5checksum, type_id,
  false AS is_analysis, is_obsolete, timestamp '2020-01-01 00:00:00' AS timeaccessioned,
  timestamp '2020-01-01 00:00:00' AS timelastmodified
FROM (
  SELECT 1 + cast(n_nationkey AS bigint) AS feature_id, cast(n_nationkey AS bigint) AS organism_id,
    cast(NULL AS string) AS name, 'chr' || cast(n_nationkey AS string) AS uniquename,
    repeat(translate(md5('chr' || cast(n_nationkey AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 400)
      AS residues,
    cast(4 AS bigint) AS type_id, false AS is_obsolete FROM {nation}
  UNION ALL
  SELECT gene_id, n, CASE WHEN o % 3 = 0 THEN 'gene' || cast(o AS string) END, 'G' || cast(o AS string),
    cast(NULL AS string), cast(CASE WHEN o % 10 = 0 THEN 5 ELSE 1 END AS bigint), status = 'P' FROM fx_gene
  UNION ALL
  SELECT tx_id, n, cast(NULL AS string), 'G' || cast(o AS string) || '.' || cast(l AS string),
    cast(NULL AS string), cast(2 AS bigint), flag = 'N' AND status = 'F' FROM fx_model
  UNION ALL
  SELECT pep_id, n, cast(NULL AS string), 'G' || cast(o AS string) || '.' || cast(l AS string) || ':pep',
    CASE WHEN partkey % 11 = 0 THEN 'X' ELSE 'M' END
      || translate(md5(cast(pep_id AS string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')
      || CASE WHEN partkey % 13 = 0 THEN '*' ELSE '' END,
    cast(3 AS bigint), flag = 'N' AND status = 'F' FROM fx_model
) f"""

VIEWS["featureloc"] = """
SELECT feature_id AS featureloc_id, feature_id, 1 + n AS srcfeature_id, (37 * o) % 12500 AS fmin,
  false AS is_fmin_partial, (37 * o) % 12500 + 30 + o % 300 AS fmax, false AS is_fmax_partial,
  cast(CASE o % 4 WHEN 0 THEN -1 WHEN 3 THEN NULL ELSE 1 END AS smallint) AS strand,
  cast(NULL AS int) AS phase, cast(NULL AS string) AS residue_info, 0 AS locgroup, 0 AS rank
FROM (SELECT gene_id AS feature_id, n, o FROM fx_gene UNION ALL SELECT tx_id, n, o FROM fx_model) f"""

VIEWS["feature_relationship"] = """
SELECT 2 * tx_id AS feature_relationship_id, tx_id AS subject_id, gene_id AS object_id, cast(8 AS bigint) AS type_id,
  cast(NULL AS string) AS value, 0 AS rank FROM fx_model
UNION ALL
SELECT 2 * pep_id, pep_id, tx_id, cast(7 AS bigint), cast(NULL AS string), 0 FROM fx_model"""

VIEWS["featureprop"] = """
SELECT 10 * pep_id AS featureprop_id, pep_id AS feature_id, cast(CASE WHEN flag = 'R' THEN 10 ELSE 25 END AS bigint)
  AS type_id, 'note ' || ymd AS value, 0 AS rank FROM fx_model WHERE flag <> 'N'
UNION ALL
SELECT 10 * (1 + cast(n_nationkey AS bigint)), 1 + cast(n_nationkey AS bigint), cast(15 AS bigint), 'true', 0
FROM {nation}
UNION ALL
SELECT 10 * gene_id + 1, gene_id, cast(12 AS bigint), 'fixture', 0 FROM fx_gene
UNION ALL
SELECT 10 * gene_id + 2, gene_id, cast(10 AS bigint), 'first, comment', 0 FROM fx_gene WHERE o % 4 = 0
UNION ALL
SELECT 10 * gene_id + 3, gene_id, cast(10 AS bigint), 'second; comment', 1 FROM fx_gene WHERE o % 8 = 0
UNION ALL
SELECT 10 * gene_id + 4, gene_id, cast(11 AS bigint), '0.5', 0 FROM fx_gene WHERE o % 6 = 0"""

VIEWS["synonym"] = """
SELECT 10 * o + 1 AS synonym_id, 'syn' || cast(o AS string) AS name, cast(20 AS bigint) AS type_id,
  'syn' || cast(o AS string) AS synonym_sgml FROM fx_gene WHERE o % 4 = 1
UNION ALL
SELECT DISTINCT 10 * (o % 50) + 2, 'alias' || cast(o % 50 AS string), cast(21 AS bigint),
  'alias' || cast(o % 50 AS string) FROM fx_gene WHERE o % 6 = 0
UNION ALL
SELECT 10 * o + 3, 'old' || cast(o AS string), cast(22 AS bigint), 'old' || cast(o AS string)
FROM fx_gene WHERE o % 5 = 2"""

VIEWS["feature_synonym"] = """
SELECT 10 * gene_id + 1 AS feature_synonym_id, 10 * o + 1 AS synonym_id, gene_id AS feature_id,
  cast(1 AS bigint) AS pub_id, o % 2 = 0 AS is_current, false AS is_internal FROM fx_gene WHERE o % 4 = 1
UNION ALL
SELECT 10 * gene_id + 2, 10 * (o % 50) + 2, gene_id, cast(1 AS bigint), true, false FROM fx_gene WHERE o % 6 = 0
UNION ALL
SELECT 10 * gene_id + 3, 10 * o + 3, gene_id, cast(1 AS bigint), o % 3 = 0, false FROM fx_gene WHERE o % 5 = 2"""

VIEWS["pub"] = """
SELECT pub_id, title, cast(NULL AS string) AS volumetitle, cast(NULL AS string) AS volume,
  cast(NULL AS string) AS series_name, cast(NULL AS string) AS issue, cast(NULL AS string) AS pyear,
  cast(NULL AS string) AS pages, cast(NULL AS string) AS miniref, uniquename, cast(27 AS bigint) AS type_id,
  false AS is_obsolete, cast(NULL AS string) AS publisher, cast(NULL AS string) AS pubplace
FROM (SELECT cast(1 AS bigint) AS pub_id, cast(NULL AS string) AS title, 'null' AS uniquename
  UNION ALL
  SELECT 10 + p_partkey, p_type, 'PMID:' || lpad(cast(p_partkey AS string), 7, '0') FROM {part}) p"""

VIEWS["feature_pub"] = """
SELECT 2 * gene_id AS feature_pub_id, gene_id AS feature_id, 10 + min(partkey) AS pub_id
FROM fx_model WHERE o % 3 = 1 GROUP BY gene_id
UNION ALL
SELECT 2 * tx_id + 1, tx_id, 10 + partkey FROM fx_model WHERE partkey % 9 = 0"""

VIEWS["feature_dbxref"] = """
SELECT 2 * gene_id AS feature_dbxref_id, gene_id AS feature_id, 4 * o + 2 AS dbxref_id, true AS is_current
FROM fx_gene WHERE o % 4 = 2
UNION ALL
SELECT 2 * gene_id + 1, gene_id, 8 * (o % 100) + 3, true FROM fx_gene WHERE o % 8 = 2"""

VIEWS["feature_cvterm"] = """
SELECT 10 * pep_id + 1 AS feature_cvterm_id, pep_id AS feature_id, 1000 + 2 * partkey AS cvterm_id,
  cast(1 AS bigint) AS pub_id, false AS is_not, 0 AS rank FROM fx_model
UNION ALL
SELECT 10 * pep_id + 2, pep_id, 1001 + 2 * suppkey, CASE WHEN partkey % 4 = 0 THEN 10 + partkey ELSE 1 END,
  status = 'O' AND flag = 'A', 0 FROM fx_model
UNION ALL
SELECT 10 * pep_id + 3, pep_id, cast(26 AS bigint), cast(1 AS bigint), false, 0 FROM fx_model WHERE l <= 2
UNION ALL
SELECT 10 * tx_id + 4, tx_id, 1001 + 2 * suppkey, cast(1 AS bigint), false, 0 FROM fx_model WHERE partkey % 17 = 0
UNION ALL
SELECT 10 * gene_id + 5, gene_id, 1001 + 2 * min(suppkey), cast(1 AS bigint), false, 0
FROM fx_model WHERE o % 9 = 0 GROUP BY gene_id"""

VIEWS["feature_cvtermprop"] = """
SELECT 100 * pep_id + 31 AS feature_cvtermprop_id, 10 * pep_id + 3 AS feature_cvterm_id, cast(24 AS bigint) AS type_id,
  CASE WHEN flag = 'N' THEN '' ELSE 'changed ' || status END AS value, 0 AS rank FROM fx_model WHERE l <= 2
UNION ALL
SELECT 100 * pep_id + 32, 10 * pep_id + 3, cast(14 AS bigint), ymd, 0 FROM fx_model WHERE l <= 2
UNION ALL
SELECT 100 * pep_id + 22, 10 * pep_id + 2, cast(14 AS bigint), ymd, 0 FROM fx_model
UNION ALL
SELECT 100 * pep_id + 23, 10 * pep_id + 2, cast(16 AS bigint),
  CASE partkey % 3 WHEN 0 THEN 'Inferred from Sequence Orthology' WHEN 1 THEN 'IDA' ELSE 'bogus' END, 0
FROM fx_model WHERE partkey % 5 <> 0
UNION ALL
SELECT 100 * pep_id + 24, 10 * pep_id + 2, cast(18 AS bigint), 'db' || cast(partkey % 3 AS string), 0
FROM fx_model WHERE partkey % 7 = 0"""

VIEWS["feature_cvterm_dbxref"] = """
SELECT 20 * pep_id AS feature_cvterm_dbxref_id, 10 * pep_id + 2 AS feature_cvterm_id, 4 * o + 2 AS dbxref_id
FROM fx_model WHERE partkey % 3 = 0
UNION ALL
SELECT 20 * pep_id + 1, 10 * pep_id + 2, 8 * (1000 + o % 5) + 3 FROM fx_model WHERE partkey % 6 = 0"""

VIEWS["feature_cvterm_pub"] = """
SELECT 10 * pep_id AS feature_cvterm_pub_id, 10 * pep_id + 2 AS feature_cvterm_id, 10 + partkey AS pub_id
FROM fx_model WHERE partkey % 5 = 1"""

VIEWS["audit_event"] = """
SELECT event_id AS audit_id,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'view' THEN 'BEFORE' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END
    AS type,
  'user' || cast(user_id AS string) AS username, cast(ts AS timestamp) AS time, user_id AS row_id, props AS value FROM {events}"""

_NAMES = re.compile(r"\b[a-z_][a-z0-9_]*\b")


def _dependencies(sql: str, views: dict[str, str]) -> list[str]:
    """View names a text uses, each after the views it is built on."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(re.sub(r"'[^']*'|`[^`]*`|\{\w+\}", " ", text)):
            if name in views and name not in order and name not in _open:
                _open.append(name)
                visit(views[name])
                order.append(name)

    _open: list[str] = []
    visit(sql)
    return order


def with_views(sql: str, extra: dict[str, str] | None = None, given: dict[str, str] | None = None) -> str:
    """Put the views a query needs in front of it as common table expressions."""
    views = {**VIEWS, **(extra or {})}
    # Spark inlines a view wherever it is named; the checking engine works it out once.
    kind = "AS" if given else "AS MATERIALIZED"
    given = given or {name: name for name in GIVEN}
    names = _dependencies(sql, views)
    text = ",\n".join(f"{name} {kind} ({views[name]})" for name in names)
    recursive = "RECURSIVE " if "RECURSIVE" in sql else ""
    body = sql.replace("RECURSIVE", "").lstrip()
    prefix = f"WITH {recursive}{text}\n" if text else ""
    return f"{prefix}{body}".format(**given)


def view(spark: SparkSession, sf_dir: str, sql: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Run a query over the views on Spark."""
    given = {name: f"parquet.`{sf_dir.rstrip('/')}/{name}.parquet`" for name in GIVEN}
    return spark.sql(with_views(sql, extra, given))


_STORES: dict[tuple[str, str], Tables] = {}
_ROOTS: dict[tuple[str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir


def _stored(root: str, names: list[str]) -> dict[str, str]:
    """Views that read what is already written."""
    return {name: f"SELECT * FROM parquet.`{root}/{name}`" for name in names}


def stored_view(spark: SparkSession, sf_dir: str, sql: str, extra: dict[str, str] | None = None) -> DataFrame:
    """The same as :func:`view`, reading the annotation tables already written."""
    t = tables(spark, sf_dir)
    stored = _stored(_ROOTS[_key(spark, sf_dir)], STORED)
    for name in _dependencies(sql, {**VIEWS, **stored, **(extra or {})}):
        if name in stored:
            t[name]
    return view(spark, sf_dir, sql, {**stored, **(extra or {})})


def _defined(spark: SparkSession, sf_dir: str, root: str, name: str) -> DataFrame:
    """The rows of a view.

    The views under all others are worked out once and written. Line items are
    brought together by order first: grouping them and joining their genes
    then takes no further exchange. Their tasks are as many as the items need,
    so that none has to spill. (The written genes are compressed so well that
    Spark would broadcast them all; orders and customers are joined again.)
    """
    given = {n: f"parquet.`{sf_dir.rstrip('/')}/{n}.parquet`" for n in GIVEN}
    if name in SHARED:
        items = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
        items.repartition(partitions_for(items.count()), "l_orderkey").createOrReplaceTempView("fx_lineitem")
        return spark.sql(with_views(f"SELECT * FROM {name}", None, {**given, "lineitem": "fx_lineitem"}))
    for below in _dependencies(VIEWS[name], VIEWS):
        if below in SHARED:
            tables(spark, sf_dir)[below]
    return view(spark, sf_dir, f"SELECT * FROM {name}", _stored(root, SHARED))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The annotation tables of one scale factor, each written as Parquet on first use."""
    key = _key(spark, sf_dir)
    if key not in _STORES:
        tune(spark)
        root = _ROOTS[key] = scratch_path(spark, "annotation")

        def resolve(name: str) -> DataFrame:
            if name in VIEWS:
                df = _defined(spark, sf_dir, root, name)
                if name in TABLES:
                    df = df.select([df[c.name].cast(c.dataType).alias(c.name) for c in TABLES[name].struct.fields])
                df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}")
                return spark.read.parquet(f"{root}/{name}")
            return spark.createDataFrame([], TABLES[name].struct)

        _STORES[key] = Tables(spark, resolve)
    return _STORES[key]


FIXTURE_TABLES = [name for name in VIEWS if name in TABLES]
SHARED = ["fx_gene", "fx_model"]
STORED = FIXTURE_TABLES + ["audit_event"] + SHARED
