from wordloom.operators.cooccurrence import (
    merge_stripes,
    pairs,
    pairs_by_record,
    pairs_intervals,
    pairs_sweep,
    roll_up,
    stripes,
    stripes_by_record,
    stripes_sweep,
    stripes_to_pairs,
)
from wordloom.operators.counts import head, row_counts, top_k, word_counts
from wordloom.operators.forward import (
    Index,
    build_index,
    indexed_counts,
    indexed_document_frequency,
    indexed_pairs,
    indexed_words,
    open_index,
)
from wordloom.operators.relevance import (
    document_frequency,
    stem_vocabulary,
    term_frequency,
    tfidf,
)
from wordloom.operators.words import exploded_words, with_words

__all__ = [
    "Index",
    "build_index",
    "document_frequency",
    "exploded_words",
    "head",
    "indexed_counts",
    "indexed_document_frequency",
    "indexed_pairs",
    "indexed_words",
    "merge_stripes",
    "open_index",
    "pairs",
    "pairs_by_record",
    "pairs_intervals",
    "pairs_sweep",
    "roll_up",
    "row_counts",
    "stem_vocabulary",
    "stripes",
    "stripes_by_record",
    "stripes_sweep",
    "stripes_to_pairs",
    "term_frequency",
    "tfidf",
    "top_k",
    "with_words",
    "word_counts",
]
