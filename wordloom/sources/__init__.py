from wordloom.sources.corpus import file_doc_id, lines, read_table, read_text, records
from wordloom.sources.lists import WordList, parse_df_table, parse_words, read_df_table, read_words, settled

__all__ = [
    "WordList",
    "file_doc_id",
    "lines",
    "parse_df_table",
    "parse_words",
    "read_df_table",
    "read_table",
    "read_text",
    "read_words",
    "records",
    "settled",
]
