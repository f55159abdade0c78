from wordloom.functions.arrays import with_runs
from wordloom.functions.porter import stem_all, with_stem
from wordloom.functions.tokens import only, tokens, without

__all__ = ["only", "stem_all", "tokens", "with_runs", "with_stem", "without"]
