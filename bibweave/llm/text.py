"""Plain-Python text normalisation shared by the operators of this subpackage.

Everything here runs inside Arrow-batched UDFs; Spark SQL has no Unicode
normalisation, so compatibility forms, ligatures and full-width characters can
only be folded on the Python side.
"""

from __future__ import annotations

import html
import re
import unicodedata

TAG = re.compile(r"</?[A-Za-z][A-Za-z0-9:]{0,15}\s*/?>")
LATEX_COMMAND = re.compile(r"\\[A-Za-z]+\*?")
INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff]")
#: A break between a main title and a subtitle: any of these, or a dash set off by white space.
STRONG_BREAK = re.compile(r"[:|(\[.,?!;\u2014\u2013\u3002\u3001]|\s[-\u2010\u2011]|[-\u2010\u2011]\s")
HYPHEN_BREAK = re.compile("(?<=\\w)[-\u2010\u2011\u2013]\\s*[\r\n]\\s*(?=\\w)")


def fold(text: str | None) -> str:
    """Decode entities, drop tags and commands, fold compatibility forms and case."""
    if not text:
        return ""
    text = html.unescape(text) if "&" in text else text
    if "<" in text:
        text = TAG.sub("", text)
    if "\\" in text:
        text = LATEX_COMMAND.sub("", text)
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", INVISIBLE.sub("", text)).casefold())


def is_letter(ch: str) -> bool:
    return ch.isalnum() or unicodedata.category(ch)[0] == "M"


def letters_and_breaks(text: str | None) -> tuple[str, list[int]]:
    """Letters and digits of the folded text, and the letter offsets before which a strong break stands.

    Offset 0 stands for a break before the first or after the last letter.
    """
    folded = fold(text)
    letters: list[str] = []
    breaks: list[int] = []
    gap = ""
    for ch in folded:
        if is_letter(ch):
            if gap:
                if STRONG_BREAK.search(gap):
                    breaks.append(len(letters))
                gap = ""
            letters.append(ch)
        else:
            gap += ch
    if gap and STRONG_BREAK.search(gap):
        breaks.append(0)
    return "".join(letters), breaks


def least_rotation(s: str) -> int:
    """Offset of the lexicographically least rotation (Booth's algorithm, linear time)."""
    n = len(s)
    if n <= 256:
        doubled = s + s
        least = min(s) if s else ""
        best, at, i = "", 0, s.find(least)
        while 0 <= i < n:
            turned = doubled[i : i + n]
            if not best or turned < best:
                best, at = turned, i
            i = s.find(least, i + 1)
        return at
    i, j, k = 0, 1, 0
    while i < n and j < n and k < n:
        a, b = s[(i + k) % n], s[(j + k) % n]
        if a == b:
            k += 1
            continue
        if a > b:
            i += k + 1
        else:
            j += k + 1
        if i == j:
            j += 1
        k = 0
    return min(i, j)


def rotation_key(text: str | None) -> tuple[str, int, list[int]]:
    """A key that doesn't depend on which part of a title stands first.

    Swapping main title and subtitle rotates the string of letters, so the least
    rotation is the same for both orders.  Returned with it, in the coordinates
    of the key: where this title starts, and where its breaks are.
    """
    letters, breaks = letters_and_breaks(text)
    n = len(letters)
    if not n:
        return "", 0, []
    at = least_rotation(letters)
    return letters[at:] + letters[:at], (n - at) % n, sorted({(b - at) % n for b in breaks})
