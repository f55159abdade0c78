from wordloom.plans.pipelines import LAYOUTS, cooccurrence, top_term_scores, top_terms, top_words

__all__ = ["LAYOUTS", "cooccurrence", "top_term_scores", "top_terms", "top_words"]
