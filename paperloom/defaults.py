"""Shipped configuration and output formats.

Everything in this module is a fixed value: it must stay exactly as written for
labels and exported files to come out right.  Nothing here is computed.
"""

# Shipped filter lists.
FILTERS = {
    "categories": ["quant-ph", "cs.IT", "math.IT"],
    "anchor_categories": ["quant-ph"],
    "query_terms": [
        "quantum error correction",
        "fault tolerant",
        "fault-tolerant",
        "stabilizer code",
        "surface code",
        "quantum code",
        "quantum codes",
        "tanner code",
        "ldpc",
        "eaqecc",
        "qecc",
        "logical qubit",
        "lattice surgery",
        "subsystem code",
        "topological code",
        "homological product",
        "gkp",
        "cat code",
        "bosonic code",
        "magic state distillation",
        "syndrome measurement",
        "syndrome extraction",
        "CSS",
    ],
    "anchor_terms": [
        "quantum error correction",
        "fault tolerant",
        "fault-tolerant",
        "stabilizer",
        "surface code",
        "quantum code",
        "quantum codes",
        "tanner code",
        "ldpc",
        "eaqecc",
        "qecc",
        "logical qubit",
        "lattice surgery",
        "subsystem code",
        "topological code",
        "homological product",
        "gkp",
        "cat code",
        "bosonic code",
        "magic state",
        "syndrome",
        "quantum memory",
    ],
    "core_terms": [
        "quantum error correction",
        "fault tolerant",
        "fault-tolerant",
        "decoder",
        "decoding",
        "syndrome",
        "stabilizer",
        "stabilizer code",
        "surface code",
        "quantum code",
        "quantum codes",
        "tanner code",
        "ldpc",
        "eaqecc",
        "qecc",
        "logical qubit",
        "lattice surgery",
        "subsystem code",
        "topological code",
        "homological product",
        "erasure decoding",
        "magic state distillation",
    ],
    "adjacent_terms": [
        "gkp",
        "cat code",
        "cat qubit",
        "bosonic code",
        "bosonic",
        "erasure",
        "transversal",
        "distillation",
        "quantum memory",
        "magic state",
        "floquet code",
        "biased noise",
    ],
    "exclude_terms": [
        "post-quantum cryptography",
        "quantum key distribution",
        "qkd",
        "qaoa",
        "max-cut",
        "beamforming",
        "mmwave",
    ],
}

# Terms that count only next to one of their context terms.
CONTEXT_GATES = {
    "magic state": ["fault tolerant", "fault-tolerant", "ftqc"],
    "erasure": ["coding", "decoding"],
}

# Points per hit and the two label thresholds.
CORE_TITLE_POINTS = 4
CORE_SUMMARY_POINTS = 2
ADJACENT_TITLE_POINTS = 2
ADJACENT_SUMMARY_POINTS = 1
EXCLUDE_POINTS = -3
CATEGORY_POINTS = 1
NO_ANCHOR_CEILING = 2
CORE_SCORE = 6
ADJACENT_SCORE = 3

# Keyword terms per source, records per landed page, default window length.
KEYWORD_CHUNK_SIZE = 6
FEED_PAGE_SIZE = 100
WINDOW_DAYS = 7

# Column order of the two row exports.
CSV_COLUMNS = [
    "label",
    "arxiv_id",
    "pdf_url",
    "title",
    "summary",
    "published",
    "updated",
    "primary_category",
    "categories",
    "authors",
    "source_queries",
    "abs_url",
]
JSONL_COLUMNS = [
    "arxiv_id",
    "title",
    "summary",
    "published",
    "updated",
    "primary_category",
    "categories",
    "authors",
    "abs_url",
    "pdf_url",
    "label",
    "source_queries",
]

# Longest abstract kept in a bibliography entry.
ABSTRACT_CHARS = 1000
