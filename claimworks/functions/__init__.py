from claimworks.functions.text import first_int, token_count, token_count_arrow

__all__ = ["first_int", "token_count", "token_count_arrow"]
