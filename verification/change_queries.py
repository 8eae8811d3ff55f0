"""Merges (M), deletions (D), change log (A), checks (V), snapshots and seeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe import schema
from helixframe.operators import changelog, deletion, merge, validate
from helixframe.schema import TABLES
from helixframe.session import scratch_path
from helixframe.streaming import audit_stream
from verification import fixtures
from verification.registry import query

# -- M: merges -------------------------------------------------------------
# Each batch keeps part of the table, changes or blanks values, repeats some
# rows later with another value, and adds new rows. ``pos`` is file order.


def _batch(table: str, key: dict[str, str], update: dict[str, str]) -> str:
    """Batch SQL: new-row key expressions and changed-value expressions per column."""
    pk = schema.TABLES[table].key
    keys, cols = list(key), list(update)
    plain = "".join(f", CASE WHEN {pk} % 5 = 1 THEN NULL WHEN {pk} % 5 = 0 THEN {e} ELSE {c} END AS {c}"
                    for c, e in update.items())
    again = "".join(f", {e} AS {c}" for c, e in update.items())
    fresh = "".join(f", {c}" for c in cols)
    return (
        f"SELECT {', '.join(keys)}{plain}, {pk} AS pos FROM {table} WHERE {pk} % 7 <> 3 "
        f"UNION ALL SELECT {', '.join(keys)}{again}, {pk} + 1000000000000 FROM {table} WHERE {pk} % 11 = 0 "
        f"UNION ALL SELECT {', '.join(f'{e} AS {k}' for k, e in key.items())}{fresh}, {pk} + 2000000000000 "
        f"FROM {table} WHERE {pk} % 97 IN (0, 1, 2)"
    )


def _merged_sql(table: str, key: list[str], update: list[str], batch: str) -> str:
    pk = schema.TABLES[table].key
    same = lambda a, b: " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in key)
    last = "".join(f", arg_max({c}, pos) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in update)
    differs = " OR ".join(f"(n.{c} IS NOT NULL AND n.{c} IS DISTINCT FROM e.{c})" for c in update) or "false"
    new = "".join(f", coalesce(n.{c}, e.{c}) AS {c}" for c in update)
    ins = "".join(f", coalesce(n.{c}, {_insert_default(table, c)}) AS {c}" for c in update)
    return f"""SELECT {', '.join('e.' + k for k in key)}{new},
 CASE WHEN n.hit AND ({differs}) THEN 'update' ELSE 'keep' END AS action
FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {pk}) AS rn FROM {table}) e
LEFT JOIN (SELECT {', '.join(key)}{last}, true AS hit FROM ({batch}) GROUP BY {', '.join(key)}) n
 ON {same('e', 'n')} AND e.rn = 1
UNION ALL
SELECT {', '.join('n.' + k for k in key)}{ins}, 'insert'
FROM (SELECT {', '.join(key)}{last} FROM ({batch}) GROUP BY {', '.join(key)}) n
WHERE NOT EXISTS (SELECT 1 FROM {table} e WHERE {same('e', 'n')})"""


def _insert_default(table: str, column: str) -> str:
    spec = next(c for c in schema.TABLES[table].columns if c.name == column)
    if not spec.required:
        return "NULL"
    return {"bool": "true" if column == "is_current" else "false", "int": "0", "string": "''"}.get(spec.kind, "NULL")


BIG = "+ 5000000000000"
MERGES = {
    "M2_organismprop": ("organismprop", {"organism_id": f"organism_id {BIG}", "type_id": "type_id"},
                        {"value": "'x' || value"}),
    "M3_organism_dbxref": ("organism_dbxref", {"organism_id": f"organism_id {BIG}", "dbxref_id": "dbxref_id"}, {}),
    "M4_db": ("db", {"name": "'new ' || name"}, {}),
    "M5_dbxref": ("dbxref", {"db_id": "db_id", "accession": "'new ' || accession"}, {}),
    "M6_cv": ("cv", {"name": "'new ' || name"}, {}),
    "M8_feature": ("feature", {"organism_id": "organism_id", "uniquename": "'N' || uniquename"},
                   {"name": "'new' || uniquename", "type_id": "type_id", "seqlen": "seqlen + 1",
                    "is_obsolete": "NOT is_obsolete"}),
    "M9_featureloc": ("featureloc", {"feature_id": f"feature_id {BIG}"},
                      {"fmin": "fmin + 1", "fmax": "fmax + 1", "strand": "strand", "phase": "2"}),
    "M11_feature_dbxref": ("feature_dbxref", {"feature_id": f"feature_id {BIG}", "dbxref_id": "dbxref_id"},
                           {"is_current": "NOT is_current"}),
    "M12_feature_cvterm": ("feature_cvterm", {"feature_id": f"feature_id {BIG}", "cvterm_id": "cvterm_id"},
                           {"is_not": "NOT is_not"}),
    "M13_feature_relationship": ("feature_relationship",
                                 {"subject_id": f"subject_id {BIG}", "type_id": "type_id", "object_id": "object_id"},
                                 {"value": "'changed'"}),
    "M14_synonym": ("synonym", {"name": "'new ' || name", "type_id": "type_id"}, {"synonym_sgml": "'<i>' || name"}),
    "M15_feature_synonym": ("feature_synonym", {"feature_id": f"feature_id {BIG}", "synonym_id": "synonym_id"},
                            {"is_internal": "NOT is_internal", "is_current": "NOT is_current"}),
    "M16_pub": ("pub", {"uniquename": "'new ' || uniquename"},
                {"title": "'on ' || uniquename", "pyear": "'2001'", "is_obsolete": "NOT is_obsolete"}),
    "M17_feature_pub": ("feature_pub", {"feature_id": f"feature_id {BIG}", "pub_id": "pub_id"}, {}),
    "M18_feature_cvtermprop": ("feature_cvtermprop", {"feature_cvterm_id": f"feature_cvterm_id {BIG}", "type_id": "type_id"},
                               {"value": "'x' || value"}),
    "M19_feature_cvterm_dbxref": ("feature_cvterm_dbxref",
                                  {"feature_cvterm_id": f"feature_cvterm_id {BIG}", "dbxref_id": "dbxref_id"}, {}),
    "M20_feature_cvterm_pub": ("feature_cvterm_pub",
                               {"feature_cvterm_id": f"feature_cvterm_id {BIG}", "pub_id": "pub_id"}, {}),
}


def _register_merge(name: str, table: str, key: dict[str, str], update: dict[str, str]) -> None:
    batch_sql = _batch(table, key, update)

    @query(name, _merged_sql(table, list(key), list(update), batch_sql))
    def _(c):
        incoming = merge.collapse(c.view(batch_sql), list(key), F.col("pos")).select(*key, *update)
        merged = merge.merge(c.tables[table], incoming, table)
        return merged.select(*key, *update, F.col("_action").alias("action"))


for _name, _case in MERGES.items():
    _register_merge(_name, *_case)

TERM_BATCH = """SELECT CASE WHEN cvterm_id % 3 = 0 THEN dbxref_id + 5000000000000 ELSE dbxref_id END AS dbxref_id,
 cv_id, CASE WHEN cvterm_id % 97 < 3 THEN 'new ' || name ELSE name END AS name FROM cvterm WHERE cvterm_id % 7 <> 3"""


@query(
    "M7_cvterm",
    f"""SELECT e.dbxref_id, e.cv_id, e.name, 'keep' AS action FROM cvterm e UNION ALL
SELECT b.dbxref_id, b.cv_id, b.name, 'insert' FROM ({TERM_BATCH}) b
WHERE b.dbxref_id NOT IN (SELECT dbxref_id FROM cvterm)
 AND NOT EXISTS (SELECT 1 FROM cvterm e WHERE e.cv_id = b.cv_id AND e.name = b.name)""",
)
def _(c):
    terms = c.tables["cvterm"]
    merged = merge.merge_terms(terms, merge.resolve_terms(terms, c.view(TERM_BATCH)))
    return merged.select("dbxref_id", "cv_id", "name", F.col("_action").alias("action"))


PROP_BATCH = """SELECT feature_id, type_id, value, featureprop_id AS pos FROM featureprop WHERE featureprop_id % 7 <> 3
UNION ALL SELECT feature_id, type_id, 'second ' || value, featureprop_id + 7 FROM featureprop WHERE featureprop_id % 3 = 0
UNION ALL SELECT feature_id, type_id, 'first ' || value, featureprop_id + 3 FROM featureprop WHERE featureprop_id % 3 = 0
UNION ALL SELECT feature_id, cast(13 AS bigint), 'described', featureprop_id FROM featureprop WHERE featureprop_id % 5 = 0"""


@query(
    "M10_featureprop",
    f"""SELECT feature_id, type_id, value, rank, 'keep' AS action FROM featureprop UNION ALL
SELECT feature_id, type_id, value, cast(coalesce(top + 1, 0) + row_number() OVER (
 PARTITION BY feature_id, type_id ORDER BY pos, value) - 1 AS int), 'insert'
FROM (SELECT feature_id, type_id, value, min(pos) AS pos FROM ({PROP_BATCH}) GROUP BY 1, 2, 3) b
LEFT JOIN (SELECT feature_id AS f, type_id AS t, max(rank) AS top FROM featureprop GROUP BY 1, 2) m
 ON m.f = b.feature_id AND m.t = b.type_id
WHERE NOT EXISTS (SELECT 1 FROM featureprop e
 WHERE e.feature_id = b.feature_id AND e.type_id = b.type_id AND e.value = b.value)""",
)
def _(c):
    batch = c.view(PROP_BATCH).withColumn("block", F.expr("pos div 1000"))
    merged = merge.merge_ranked_properties(c.tables["featureprop"], batch, ["block"], ["pos"])
    return merged.select("feature_id", "type_id", "value", "rank", F.col("_action").alias("action"))


FIND_BATCH = """SELECT name, CASE WHEN cvterm_id % 2 = 0 THEN definition ELSE 'other' END AS definition FROM cvterm"""


@query(
    "M21_find_or_insert",
    f"""SELECT name, definition, 'keep' AS action FROM cvterm UNION ALL
SELECT name, definition, 'insert' FROM (SELECT DISTINCT name, definition FROM ({FIND_BATCH})) b
WHERE NOT EXISTS (SELECT 1 FROM cvterm e WHERE e.name = b.name AND e.definition IS NOT DISTINCT FROM b.definition)""",
)
def _(c):
    merged = merge.find_or_insert(c.tables["cvterm"], c.view(FIND_BATCH), "cvterm")
    return merged.select("name", "definition", F.col("_action").alias("action"))


# -- D: deletions ----------------------------------------------------------

LOADED = """SELECT organism_id, uniquename FROM feature WHERE feature_id % 7 <> 3
UNION ALL SELECT organism_id, 'N' || uniquename FROM feature WHERE feature_id % 97 = 0"""


@query(
    "D7_mark_obsolete",
    f"""SELECT f.uniquename, f.is_obsolete OR (f.organism_id % 2 = 1 AND l.uniquename IS NULL) AS is_obsolete,
 CASE WHEN NOT f.is_obsolete AND f.organism_id % 2 = 1 AND l.uniquename IS NULL THEN 'update' ELSE 'keep' END AS action
FROM feature f LEFT JOIN ({LOADED}) l ON f.organism_id = l.organism_id AND f.uniquename = l.uniquename""",
)
def _(c):
    organisms = c.tables["organism"].where("organism_id % 2 = 1")
    out = deletion.mark_obsolete(c.tables["feature"], c.view(LOADED), organisms)
    return out.select("uniquename", "is_obsolete", F.col("_action").alias("action"))


@query(
    "D8_fresh_load_guard",
    "SELECT o.abbreviation, count(*) AS n_features FROM feature f JOIN organism o ON f.organism_id = o.organism_id"
    " GROUP BY o.abbreviation",
)
def _(c):
    return deletion.feature_counts(c.tables).select("abbreviation", "n_features")


_F = "SELECT feature_id FROM feature WHERE organism_id IN (SELECT organism_id FROM organism WHERE abbreviation = 'NATION_3')"
_FC = f"SELECT feature_cvterm_id FROM feature_cvterm WHERE feature_id IN ({_F})"
_GONE = {
    "organism": "abbreviation = 'NATION_3'",
    "organismprop": "organism_id = 3", "organism_dbxref": "organism_id = 3",
    "feature": f"feature_id IN ({_F})",
    "featureloc": f"feature_id IN ({_F})", "featureprop": f"feature_id IN ({_F})",
    "feature_relationship": f"subject_id IN ({_F}) OR object_id IN ({_F})",
    "feature_synonym": f"feature_id IN ({_F})", "feature_pub": f"feature_id IN ({_F})",
    "feature_dbxref": f"feature_id IN ({_F})", "feature_cvterm": f"feature_id IN ({_F})",
    "feature_cvtermprop": f"feature_cvterm_id IN ({_FC})", "feature_cvterm_dbxref": f"feature_cvterm_id IN ({_FC})",
    "feature_cvterm_pub": f"feature_cvterm_id IN ({_FC})",
}


@query(
    "D9_delete_organism",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n} WHERE {w}" for n, w in _GONE.items()),
)
def _(c):
    rows = c.tables["organism"].where(F.col("abbreviation") == "NATION_3")
    gone = deletion.doomed_rows(c.tables, "organism", rows)
    parts = [
        gone[n].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in _GONE
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_CHR = "SELECT feature_id FROM feature WHERE uniquename LIKE 'chr%' AND organism_id % 3 = 0"


@query(
    "D9_cascade_sets_null",
    f"""SELECT l.feature_id, l.fmin, CASE WHEN l.srcfeature_id IN ({_CHR}) THEN NULL ELSE l.srcfeature_id END
 AS srcfeature_id FROM featureloc l WHERE l.feature_id NOT IN ({_CHR})""",
)
def _(c):
    rows = c.tables["feature"].where("uniquename like 'chr%' and organism_id % 3 = 0")
    left = deletion.cascade_delete(c.tables, "feature", rows)["featureloc"]
    return left.select("feature_id", "fmin", "srcfeature_id")


# -- A: change log ---------------------------------------------------------

AFTER = """SELECT feature_id, organism_id, CASE WHEN feature_id % 5 = 0 THEN 'new' || uniquename ELSE name END AS name,
 uniquename, type_id, CASE WHEN feature_id % 13 = 0 THEN true ELSE is_obsolete END AS is_obsolete
FROM feature WHERE feature_id % 7 <> 3
UNION ALL SELECT feature_id + 1000000000000, organism_id, name, 'N' || uniquename, type_id, false
FROM feature WHERE feature_id % 97 = 0"""
_COLS = "feature_id, organism_id, name, uniquename, type_id, is_obsolete"
CAPTURED = f"""SELECT 'INSERT' AS type, n.* FROM ({AFTER}) n WHERE feature_id NOT IN (SELECT feature_id FROM feature)
UNION ALL SELECT 'DELETE', {_COLS} FROM feature WHERE feature_id NOT IN (SELECT feature_id FROM ({AFTER}) q)
UNION ALL SELECT 'BEFORE', e.feature_id, e.organism_id, e.name, e.uniquename, e.type_id, e.is_obsolete
 FROM feature e JOIN ({AFTER}) n ON e.feature_id = n.feature_id
 WHERE e.name IS DISTINCT FROM n.name OR e.is_obsolete <> n.is_obsolete
UNION ALL SELECT 'UPDATE', n.feature_id, n.organism_id, n.name, n.uniquename, n.type_id, n.is_obsolete
 FROM feature e JOIN ({AFTER}) n ON e.feature_id = n.feature_id
 WHERE e.name IS DISTINCT FROM n.name OR e.is_obsolete <> n.is_obsolete"""


def _captured(c):
    before = c.tables["feature"].select(*_COLS.split(", "))
    return changelog.capture(before, c.view(AFTER), "feature")


@query("A1_capture_changes", CAPTURED)
def _(c):
    return _captured(c)


@query("A2_audit_table", f"SELECT type, 'curator' AS username, cast('2024-05-01' AS date) AS day, {_COLS} FROM ({CAPTURED}) q")
def _(c):
    log = changelog.audit_rows(_captured(c), "feature", "curator", F.timestamp_seconds(F.lit(1714521600)))
    names = [f.name for f in schema.audit_struct("feature").fields if f.name in log.columns]
    return log.select(*names).select("type", "username", F.to_date("time").alias("day"), *_COLS.split(", "))


@query(
    "A3_parent_log",
    f"""SELECT table_name, type, count(*) AS n_rows FROM (
SELECT 'feature' AS table_name, type FROM ({CAPTURED}) q UNION ALL SELECT 'event', type FROM audit_event) a
GROUP BY table_name, type""",
)
def _(c):
    feature_log = changelog.audit_rows(_captured(c), "feature", "curator", F.timestamp_seconds(F.lit(1714521600)))
    logs = {"feature": feature_log, "event": c.tables["audit_event"]}
    return changelog.parent_view(logs).groupBy("table_name", "type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "A4_age_out",
    """SELECT CASE WHEN time < timestamp '2024-01-10 00:00:00' THEN 'backup' ELSE 'log' END AS place, audit_id, type,
 username FROM audit_event""",
)
def _(c):
    old, rest = changelog.age_out(c.tables["audit_event"], "2024-01-10")
    out = old.withColumn("place", F.lit("backup")).unionByName(rest.withColumn("place", F.lit("log")))
    return out.select("place", "audit_id", "type", "username")


def _event_files(c):
    path = scratch_path(c.spark, "events")
    c.tables["audit_event"].repartitionByRange(4, "audit_id").write.parquet(path)
    return path, c.tables["audit_event"].schema


@query("A5_stream_to_log", "SELECT audit_id, type, username, value FROM audit_event")
def _(c):
    path, columns = _event_files(c)
    sink = scratch_path(c.spark, "log")
    events = audit_stream.once_per_event(audit_stream.change_events(c.spark, path, columns), "10 days")
    audit_stream.append_log(events, sink, scratch_path(c.spark, "stream")).awaitTermination()
    return c.spark.read.parquet(sink).select("audit_id", "type", "username", "value")


@query(
    "A5_stream_to_table",
    """SELECT row_id, audit_id, type, value FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY audit_id DESC)
 AS n FROM audit_event WHERE type <> 'BEFORE') q WHERE n = 1 AND type <> 'DELETE'""",
)
def _(c):
    path, columns = _event_files(c)
    state = scratch_path(c.spark, "state")
    events = audit_stream.change_events(c.spark, path, columns, files_per_batch=2)
    stream = audit_stream.maintain_table(events, "row_id", state, scratch_path(c.spark, "stream"))
    stream.awaitTermination()
    return audit_stream.current_rows(c.spark, state, columns).select("row_id", "audit_id", "type", "value")


# -- V: checks -------------------------------------------------------------

DIRTY = {
    "dirty_feature": """SELECT * FROM feature UNION ALL
SELECT feature_id + 5000000000000, dbxref_id, organism_id, name, uniquename, residues, seqlen, md5checksum, type_id,
 is_analysis, is_obsolete, timeaccessioned, timelastmodified FROM feature WHERE feature_id % 97 = 0""",
    "dirty_relationship": """SELECT feature_relationship_id,
 CASE WHEN subject_id % 89 = 0 THEN -1 WHEN subject_id % 83 = 0 THEN NULL ELSE subject_id END AS subject_id,
 CASE WHEN object_id % 79 = 0 THEN -object_id ELSE object_id END AS object_id, type_id, value,
 CASE WHEN object_id % 71 = 0 THEN NULL ELSE rank END AS rank FROM feature_relationship""",
    "dirty_loc": """SELECT featureloc_id, feature_id, srcfeature_id, CASE WHEN feature_id % 67 = 0 THEN fmax + 1
 WHEN feature_id % 61 = 0 THEN NULL ELSE fmin END AS fmin, fmax FROM featureloc""",
    "dirty_term": """SELECT cvterm_id, CASE WHEN cvterm_id % 31 = 0 THEN cv_id + 100 ELSE cv_id END AS cv_id, dbxref_id,
 CASE WHEN cvterm_id % 29 = 0 THEN NULL ELSE name END AS name, definition, is_obsolete, is_relationshiptype FROM cvterm""",
}
CLEANED = {"feature": "dirty_feature", "feature_relationship": "dirty_relationship", "cvterm": "dirty_term"}
CHECKED = fixtures.FIXTURE_TABLES


def _dirty_tables(c):
    """All fixture tables, some of them with faults."""
    return c.tables.with_tables({n: c.view(f"SELECT * FROM {v}", DIRTY) for n, v in CLEANED.items()})


def _unique_sql(name: str) -> list[str]:
    texts = []
    for key in ((TABLES[name].key,),) + TABLES[name].unique:
        shown = " || ',' || ".join(f"cast({k} AS string)" for k in key)
        texts.append(f"""SELECT '{name}' AS table_name, '{','.join(key)}' AS "constraint", {shown} AS key, count(*) AS n_rows
FROM {CLEANED.get(name, name)} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in key)} GROUP BY {', '.join(key)} HAVING count(*) > 1""")
    return texts


def _reference_sql(name: str) -> list[str]:
    texts = []
    for ref in TABLES[name].references:
        known = f" AND {ref.name} NOT IN (SELECT {TABLES[ref.parent].key} FROM {CLEANED.get(ref.parent, ref.parent)})" if ref.parent in CHECKED else ""
        texts.append(f"""SELECT '{name}' AS table_name, '{ref.name}' AS column_name, {ref.name} AS value, count(*) AS n_rows
FROM {CLEANED.get(name, name)} WHERE {ref.name} IS NOT NULL{known} GROUP BY {ref.name}""")
    return texts


def _required_sql(name: str) -> list[str]:
    return [f"""SELECT '{name}' AS table_name, '{col.name}' AS column_name, count(*) AS n_rows FROM {CLEANED.get(name, name)}
WHERE {col.name} IS NULL HAVING count(*) > 0""" for col in TABLES[name].columns if col.required]


def _all_sql(texts) -> str:
    return "\nUNION ALL ".join(text for name in CHECKED for text in texts(name))


@query("V1_unique", _all_sql(_unique_sql), DIRTY)
def _(c):
    return validate.all_violations(_dirty_tables(c), CHECKED)["unique"]


@query("V2_foreign_keys", _all_sql(_reference_sql), DIRTY)
def _(c):
    return validate.all_violations(_dirty_tables(c), CHECKED)["references"]


@query("V3_required", _all_sql(_required_sql), DIRTY)
def _(c):
    return validate.all_violations(_dirty_tables(c), CHECKED)["required"]


@query("V3_check", "SELECT featureloc_id, fmin, fmax FROM dirty_loc WHERE fmin > fmax", DIRTY)
def _(c):
    rows = validate.check_violations(c.view("SELECT * FROM dirty_loc", DIRTY), "featureloc")
    return rows.select("featureloc_id", "fmin", "fmax")


@query(
    "V4_enum_domain",
    """SELECT event_type AS value, count(*) AS n_rows FROM {events} WHERE event_type NOT IN
 ('INSERT', 'UPDATE', 'DELETE', 'BEFORE') GROUP BY event_type""",
)
def _(c):
    return validate.domain_violations(c.view("SELECT event_type AS type FROM {events}"))


# -- S10, S12: scans and snapshots -----------------------------------------


@query("S10_equality_scan", "SELECT feature_id, uniquename FROM feature WHERE organism_id = 4 AND type_id = 2 AND name IS NULL")
def _(c):
    return c.tables.scan("feature", organism_id=4, type_id=2, name=None).select("feature_id", "uniquename")
