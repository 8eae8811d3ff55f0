"""Names, codes and defaults that results depend on."""

# Feature type names, compared in lower case.
GENE_TYPES = ["gene", "pseudogene"]
TRANSCRIPT_TYPES = ["mrna", "rrna", "trna", "snrna", "ncrna", "scrna", "snorna", "pseudogenic_transcript"]
PROTEIN_TYPES = ["polypeptide"]

# Relationship, property and synonym types handled by file imports.
PARENT_TYPES = ["part_of", "derives_from"]
PROPERTY_TYPES = ["comment", "description", "score", "source"]
SYNONYM_TYPES = ["alias", "synonym", "previous_systematic_id"]

# Attribute keys of the nine-column format that the import understands.
KNOWN_ATTRIBUTES = (
    PROPERTY_TYPES + PARENT_TYPES + SYNONYM_TYPES
    + ["id", "name", "parent", "note", "dbxref", "ontology_term", "size", "literature", "translation",
       "protein_source_id"]
)

# Vocabularies and databases.
SEQUENCE_CV = "sequence"
RELATIONSHIP_CV = "relationship"
PRODUCT_CV = "genedb_products"
CHANGE_CV = "annotation_change"
SYNONYM_CV = "genedb_synonym_type"
PROPERTY_CV = "feature_property"
ONTOLOGY_SYNONYM_CV = "synonym_type"
PUBLIC_FLAG = "genedb_public"
TOP_LEVEL = "top_level_seq"
GO_DB = "GO"
PRODUCT_DB = "PRODUCT"
WIKIDATA_DB = "Wikidata"
NULL_PUB = "null"

# Parents of each relationship type: the vocabulary its term is looked up in.
PARENT_CV = {"part_of": RELATIONSHIP_CV, "derives_from": SEQUENCE_CV}

# Evidence codes of the gene-association format.
EVIDENCE = {
    "EXP": "Inferred from Experiment",
    "IDA": "Inferred from Direct Assay",
    "IPI": "Inferred from Physical Interaction",
    "IMP": "Inferred from Mutant Phenotype",
    "IGI": "Inferred from Genetic Interaction",
    "IEP": "Inferred from Expression Pattern",
    "HTP": "Inferred from High Throughput Experiment",
    "HDA": "Inferred from High Throughput Direct Assay",
    "HMP": "Inferred from High Throughput Mutant Phenotype",
    "HGI": "Inferred from High Throughput Genetic Interaction",
    "HEP": "Inferred from High Throughput Expression Pattern",
    "ISS": "Inferred from Sequence or structural Similarity",
    "ISO": "Inferred from Sequence Orthology",
    "ISA": "Inferred from Sequence Alignment",
    "ISM": "Inferred from Sequence Model",
    "IGC": "Inferred from Genomic Context",
    "IBA": "Inferred from Biological aspect of Ancestor",
    "IBD": "Inferred from Biological aspect of Descendant",
    "IKR": "Inferred from Key Residues",
    "IRD": "Inferred from Rapid Divergence",
    "RCA": "Inferred from Reviewed Computational Analysis",
    "TAS": "Traceable Author Statement",
    "NAS": "Non-traceable Author Statement",
    "IC": "Inferred by Curator",
    "ND": "No biological Data available",
    "IEA": "Inferred from Electronic Annotation",
    "NR": "Not recorded",
}
DEFAULT_EVIDENCE = "NR"
ASPECTS = {"cellular_component": "C", "molecular_function": "F", "biological_process": "P"}
REFERENCE_DBS = ["PMID", "GO_REF", "SGD_REF"]
DEFAULT_REFERENCE = "GO_REF:0000002"

# Columns of the gene-association format, version 1.0.
GAF_COLUMNS = [
    "DB", "DB_Object_ID", "DB_Object_Symbol", "Qualifier", "GO_ID", "DB:Reference", "Evidence", "With", "Aspect",
    "DB_Object_Name", "Synonym", "DB_Object_Type", "Taxon_ID", "Date", "Assigned_By",
]

# Letters allowed in sequences (ambiguous nucleotides, extended amino acids).
NUCLEOTIDE_PATTERN = "(?i)^[GATCRYWSMKHBVDN]+$"
PROTEIN_PATTERN = "(?i)^M([A-Z]*[A-Z*])?$"
NUCLEOTIDES = "ACGTUMRWSYKVHDBNX"
COMPLEMENTS = "TGCAAKYWSRMBDHVNX"

# Seed vocabulary: (db, cv, terms, relationship flag).
SEED_TERMS = [
    ("null", "null", ["null"], 0),
    ("RO", "relationship", ["is_a"], 1),
    ("internal", "synonym_type", ["exact", "narrow", "broad", "related"], 0),
    ("internal", "cvterm_property_type",
     ["comment", "is_anonymous", "is_transitive", "is_anti_symmetric", "is_reflexive", "is_symmetric", "is_cyclic"],
     0),
    ("internal", "cvterm_property_type", ["intersection_of", "disjoint_from"], 1),
    ("SOFP", "feature_property", ["comment", "score", "source", "description", "date"], 0),
    ("genedb_misc", "genedb_synonym_type",
     ["synonym", "alias", "systematic_id", "previous_systematic_id", "temporary_systematic_id"], 0),
    ("genedb_misc", "genedb_misc",
     ["top_level_seq", "evidence", "genedb_public", "assigned_by", "colour", "version"], 0),
    ("PRODUCT", "genedb_products", [], 0),
]
# Needed by organism and association jobs although the seed above lacks them.
SEED_EXTRA_TERMS = [("genedb_misc", "genedb_misc", ["taxonId"], 0)]
SEED_EXTRA_DBS = ["Wikidata"]
# Usually loaded from ontology files; handy for a first start.
SEED_SEQUENCE_TERMS = [
    ("SO", "sequence",
     ["gene", "intron", "exon", "CDS", "mRNA", "chromosome", "contig", "supercontig", "region"], 0),
    ("RO", "relationship", ["part_of", "derives_from"], 1),
    # The jobs look derives_from up in the sequence vocabulary.
    ("SO", "sequence", ["derives_from"], 1),
]
