"""Regex building blocks shared by the cleaning expressions.

The reference runs Python ``re`` on ``str`` patterns, where ``\\s``, ``\\d`` and
``\\b`` are Unicode-aware. Spark uses java.util.regex; these pieces spell the
same sets out explicitly so the Java patterns behave like the Python ones.
"""

# The characters Python's str.isspace() accepts (the meaning of
# ``\s`` in a Python str pattern). Java's \s lacks U+001C..U+001F.
WS_CHARS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = f"[{WS_CHARS}]"
# Those of them in ASCII, but the space.
ASCII_WS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f"
# All of them but the space, said by what they are not: one comparison passes most characters of a text.
WS_BUT_SPACE = (
    r"[^ -\x{84}\x00-\x08\x0E-\x1B\x{86}-\x{9F}\x{A1}-\x{167F}\x{1681}-\x{1FFF}\x{200B}-\x{2027}"
    r"\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}]"
)
# A run of white space that is not already one space; one range passes the printable characters of ASCII.
WS_RUN = f"(?![!-~])(?:{WS_BUT_SPACE}{WS}*| {WS}+)"
# Python's \d on str = Unicode decimal digits.
DIGIT = r"\p{Nd}"
# Characters that count as "word" characters for Python's \b (str.isalnum or _).
WORD_CHARS = r"\p{L}\p{N}_"
