"""Building Java patterns from term lists and from Python-style patterns."""

from __future__ import annotations

import re

from safelabel.functions.base import SPACE, SPACE_CHARS, WORD, WORD_CHARS
from safelabel.functions.text import fold_literal

_SPECIAL = set("\\^$.|?*+()[]{}-&~#")


def quote(text: str) -> str:
    return "".join("\\" + ch if ch in _SPECIAL else ch for ch in text)


def any_of(terms) -> str:
    """Pattern that finds any of the literal terms in one pass over a text.

    Terms with a common start share it, so a position is given up at the first
    letter that no term has; the leading look-ahead rejects most positions at once.
    """
    root: dict = {}
    for term in sorted(set(terms)):
        node = root
        for ch in term:
            node = node.setdefault(ch, {})
        node[""] = {}

    def render(node: dict) -> str:
        if "" in node:  # a shorter term ends here; a longer one adds nothing
            return ""
        parts = [quote(ch) + render(child) for ch, child in node.items()]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    if not root or "" in root:
        return "" if root else "(?!)"
    return "(?=[" + "".join(quote(ch) for ch in root) + "])" + render(root)


def _split_head(pattern: str) -> tuple[str, str]:
    r"""Letters right after a leading ``\b``, and the rest; no letters when there are none."""
    hit = re.match(r"\\b(\w+)", pattern)
    if not hit or "|" in pattern:
        return "", pattern
    end = hit.end() - (pattern[hit.end() : hit.end() + 1] in ("?", "*", "+", "{") and 1)
    return pattern[2:end], pattern[end:]


def to_java(pattern: str) -> str:
    r"""A Python-style pattern for use on folded text.

    ``\b``, ``\w``, ``\d`` and ``\s`` take their Unicode meaning.  A pattern that starts
    with a word looks for its letters first and at the word's edge afterwards, as the
    letters are quick to rule out.
    """
    outside = {
        r"\b": f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))",
        r"\B": f"(?:(?<={WORD})(?={WORD})|(?<!{WORD})(?!{WORD}))",
        r"\w": WORD, r"\W": f"[^{WORD_CHARS}]", r"\s": SPACE, r"\S": f"[^{SPACE_CHARS}]", r"\d": r"\p{Nd}", r"\D": r"\P{Nd}",
    }
    in_brackets = {r"\w": WORD_CHARS, r"\s": SPACE_CHARS, r"\d": r"\p{Nd}", r"\D": r"\P{Nd}"}
    head, rest = _split_head(pattern)
    head = quote(fold_literal(head))
    out, i, inside = [f"{head}(?<!{WORD}{head})" if head else ""], 0, False
    while i < len(rest):
        two = rest[i : i + 2]
        if two.startswith("\\"):
            out.append((in_brackets if inside else outside).get(two, two))
        else:
            ch = rest[i]
            inside = (inside or ch == "[") and ch != "]"
            out.append(fold_literal(ch))
            i += 1
            continue
        i += 2
    return "".join(out)


def classify(pattern: str) -> tuple[str, str]:
    r"""``\bterm\w*`` is a stem, ``\bterm\b`` a word, anything else a phrase."""
    hit = re.fullmatch(r"\\b(\w+)(\\w\*|\\b)", pattern)
    if hit:
        return ("stem" if hit.group(2) == r"\w*" else "word"), hit.group(1)
    return "phrase", pattern


def leading_word(pattern: str) -> tuple[str | None, bool]:
    r"""Letters with which every match starts a word, and whether the word may go on.

    ``None`` when the pattern has no such letters.
    """
    head, rest = _split_head(pattern)
    return (fold_literal(head), not rest.startswith((r"\s+", r"\b"))) if head else (None, True)
