from wordloom.sinks.text import pair_text, score_text, stripe_text, tsv_lines, write_tsv

__all__ = ["pair_text", "score_text", "stripe_text", "tsv_lines", "write_tsv"]
