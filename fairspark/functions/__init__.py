from .geometry import nearest, sqdist
from .text import line_array, text_tokens, tokens

__all__ = ["nearest", "sqdist", "line_array", "text_tokens", "tokens"]
