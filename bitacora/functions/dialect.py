"""Unicode-aware building blocks for the Java patterns used in this package.

Word characters are letters, numbers and the underscore; combining marks are
not.  Whitespace includes the four ASCII separators U+001C to U+001F.  Java's
own ``\\w``, ``\\s`` and ``\\b`` differ on both counts, so patterns here spell
the classes out.
"""

from __future__ import annotations

WORD_SET = r"\p{L}\p{N}_"
WORD = f"[{WORD_SET}]"
SPACE_SET = r"\s\x1c-\x1f"
SPACE = f"[{SPACE_SET}]"
NOT_AFTER_WORD = f"(?<!{WORD})"
NOT_BEFORE_WORD = f"(?!{WORD})"
AFTER_WORD = f"(?<={WORD})"
BEFORE_WORD = f"(?={WORD})"
BOUNDARY = f"(?:{AFTER_WORD}{NOT_BEFORE_WORD}|{NOT_AFTER_WORD}{BEFORE_WORD})"

# Every character that counts as whitespace, for trimming without a pattern.
SPACE_CHARS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def is_word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def literal(text: str) -> str:
    """``text`` as a pattern that matches exactly itself."""
    return "".join(
        "\\" + ch if ch.isascii() and not (ch.isalnum() or ch in "_\n\r\t\x00") else ch
        for ch in text
    )


def replacement(text: str) -> str:
    """``text`` as a replacement in which nothing is special."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def edges(phrase: str) -> tuple[str, str]:
    """Assertions for a word boundary before and after a fixed phrase.

    A boundary lies between a word character and something else, so which side
    must be the word follows from the first and last character of the phrase.
    """
    before = NOT_AFTER_WORD if is_word(phrase[0]) else AFTER_WORD
    after = NOT_BEFORE_WORD if is_word(phrase[-1]) else BEFORE_WORD
    return before, after


def whole_phrase(phrase: str) -> str:
    """Pattern for ``phrase`` between word boundaries.

    The literal comes first and the left edge is checked by looking back over
    it: a pattern that starts with plain text is searched by skipping ahead
    instead of testing every position.
    """
    if not phrase:
        return BOUNDARY
    text = literal(phrase)
    left = f"(?<!{WORD}{text})" if is_word(phrase[0]) else f"(?<={WORD}{text})"
    return f"{text}{left}{edges(phrase)[1]}"
