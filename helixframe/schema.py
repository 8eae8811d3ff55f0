"""Catalogue of the annotation tables: columns, keys, references and checks.

Every table has a surrogate key ``<table>_id`` as its first column. Spark does
not enforce keys; :mod:`helixframe.operators.validate` checks them and
:mod:`helixframe.operators.deletion` follows the references.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "short": T.ShortType(),
    "bool": T.BooleanType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str = "string"
    required: bool = False
    parent: str | None = None
    on_delete: str = "cascade"


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    unique: tuple[tuple[str, ...], ...]
    check: str | None = None

    @property
    def key(self) -> str:
        return self.columns[0].name

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def references(self) -> list[Column]:
        return [c for c in self.columns if c.parent]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, TYPES[c.kind], True) for c in self.columns])


def _column(text: str) -> Column:
    """``name``, ``name!`` (required), ``name:kind``; default kind is string."""
    required = text.endswith("!")
    name, _, kind = text.rstrip("!").partition(":")
    return Column(name, kind or "string", required)


def _ref(parent: str, name: str | None = None, required: bool = True, on_delete: str = "cascade") -> Column:
    return Column(name or f"{parent}_id", "long", required, parent, on_delete)


def _table(name: str, *columns: str | Column, unique: list[str], check: str | None = None) -> Table:
    cols = [Column(f"{name}_id", "long", True)]
    cols += [c if isinstance(c, Column) else _column(c) for c in columns]
    return Table(name, tuple(cols), tuple(tuple(u.split()) for u in unique), check)


def _prop(name: str, parent: str, value: str = "value") -> Table:
    """Property table: one row per (parent, type, rank)."""
    return _table(
        name, _ref(parent), _ref("cvterm", "type_id"), value, "rank:int!",
        unique=[f"{parent}_id type_id rank"],
    )


def _link(name: str, left: str, right: str, *extra: str) -> Table:
    """Link table between two parents."""
    return _table(name, _ref(left), _ref(right), *extra, unique=[f"{left}_id {right}_id"])


_ALL = [
    _table("db", "name!", "description", "urlprefix", "url", unique=["name"]),
    _table("dbxref", _ref("db"), "accession!", "version!", "description", unique=["db_id accession version"]),
    _prop("dbxrefprop", "dbxref", "value!"),
    _table("cv", "name!", "definition", unique=["name"]),
    _table(
        "cvterm", _ref("cv"), _ref("dbxref"), "name!", "definition", "is_obsolete:int!", "is_relationshiptype:int!",
        unique=["name cv_id is_obsolete", "dbxref_id"],
    ),
    _table(
        "cvtermprop", _ref("cvterm"), _ref("cvterm", "type_id"), "value!", "rank:int!",
        unique=["cvterm_id type_id value rank"],
    ),
    _table(
        "cvterm_relationship", _ref("cvterm", "type_id"), _ref("cvterm", "subject_id"), _ref("cvterm", "object_id"),
        unique=["subject_id object_id type_id"],
    ),
    _table(
        "cvtermsynonym", _ref("cvterm"), "synonym!", _ref("cvterm", "type_id", False, "set null"),
        unique=["cvterm_id synonym"],
    ),
    _link("cvterm_dbxref", "cvterm", "dbxref", "is_for_definition:int!"),
    _table(
        "cvtermpath", _ref("cvterm", "type_id", False, "set null"), _ref("cvterm", "subject_id"),
        _ref("cvterm", "object_id"), _ref("cv"), "pathdistance:int",
        unique=["subject_id object_id type_id pathdistance"],
    ),
    _table(
        "organism", "abbreviation!", "genus!", "species!", "common_name", "infraspecific_name",
        _ref("cvterm", "type_id", False), "comment",
        unique=["genus species infraspecific_name", "abbreviation"],
    ),
    _link("organism_dbxref", "organism", "dbxref"),
    _prop("organismprop", "organism"),
    _table(
        "pub", "title", "volumetitle", "volume", "series_name", "issue", "pyear", "pages", "miniref", "uniquename!",
        _ref("cvterm", "type_id"), "is_obsolete:bool!", "publisher", "pubplace",
        unique=["uniquename"],
    ),
    _link("pub_dbxref", "pub", "dbxref", "is_current:bool!"),
    _table(
        "pub_relationship", _ref("pub", "subject_id"), _ref("pub", "object_id"), _ref("cvterm", "type_id"),
        unique=["subject_id object_id type_id"],
    ),
    _table(
        "pubauthor", _ref("pub"), "rank:int!", "editor:bool!", "surname!", "givennames", "suffix",
        unique=["pub_id rank"],
    ),
    _prop("pubprop", "pub"),
    _table(
        "feature", _ref("dbxref", None, False, "set null"), _ref("organism"), "name", "uniquename!", "residues",
        "seqlen:long", "md5checksum", _ref("cvterm", "type_id"), "is_analysis:bool!", "is_obsolete:bool!",
        "timeaccessioned:timestamp!", "timelastmodified:timestamp!",
        unique=["organism_id uniquename type_id"],
    ),
    _table(
        "feature_cvterm", _ref("feature"), _ref("cvterm"), _ref("pub"), "is_not:bool!", "rank:int!",
        unique=["feature_id cvterm_id pub_id rank"],
    ),
    _link("feature_cvterm_dbxref", "feature_cvterm", "dbxref"),
    _prop("feature_cvtermprop", "feature_cvterm"),
    _link("feature_cvterm_pub", "feature_cvterm", "pub"),
    _link("feature_dbxref", "feature", "dbxref", "is_current:bool!"),
    _link("feature_pub", "feature", "pub"),
    _prop("feature_pubprop", "feature_pub"),
    _table(
        "feature_relationship", _ref("feature", "subject_id"), _ref("feature", "object_id"), _ref("cvterm", "type_id"),
        "value", "rank:int!",
        unique=["subject_id object_id type_id rank"],
    ),
    _link("feature_relationship_pub", "feature_relationship", "pub"),
    _prop("feature_relationshipprop", "feature_relationship"),
    _link("feature_relationshipprop_pub", "feature_relationshipprop", "pub"),
    _table("synonym", "name!", _ref("cvterm", "type_id"), "synonym_sgml!", unique=["name type_id"]),
    _table(
        "feature_synonym", _ref("synonym"), _ref("feature"), _ref("pub"), "is_current:bool!", "is_internal:bool!",
        unique=["synonym_id feature_id pub_id"],
    ),
    _table(
        "featureloc", _ref("feature"), _ref("feature", "srcfeature_id", False, "set null"), "fmin:long",
        "is_fmin_partial:bool!", "fmax:long", "is_fmax_partial:bool!", "strand:short", "phase:int", "residue_info",
        "locgroup:int!", "rank:int!",
        unique=["feature_id locgroup rank"], check="fmin <= fmax",
    ),
    _link("featureloc_pub", "featureloc", "pub"),
    _prop("featureprop", "feature"),
    _link("featureprop_pub", "featureprop", "pub"),
    _table(
        "analysis", "name", "description", "program!", "programversion!", "algorithm", "sourcename", "sourceversion",
        "sourceuri", "timeexecuted:timestamp!",
        unique=["program programversion sourcename"],
    ),
    _table(
        "analysisfeature", _ref("feature"), _ref("analysis"), "rawscore:double", "normscore:double",
        "significance:double", "identity:double",
        unique=["feature_id analysis_id"],
    ),
    _table(
        "analysisprop", _ref("analysis"), _ref("cvterm", "type_id"), "value", unique=["analysis_id type_id value"],
    ),
]

TABLES: dict[str, Table] = {t.name: t for t in _ALL}

# Change-log base columns; each table's log adds the table's own columns.
AUDIT_COLUMNS = (
    Column("audit_id", "long", True),
    Column("type", "string", True),
    Column("username", "string", True),
    Column("time", "timestamp", True),
)
AUDIT_TYPES = ("INSERT", "UPDATE", "DELETE", "BEFORE")


def audit_struct(table: str) -> T.StructType:
    """Schema of the change log of one table."""
    base = [T.StructField(c.name, TYPES[c.kind], True) for c in AUDIT_COLUMNS]
    return T.StructType(base + TABLES[table].struct.fields)
