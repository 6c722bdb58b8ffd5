"""Scalar text functions as column expressions; none of them leaves the JVM.

White space is Unicode's, as everywhere in this package: Java's classes are told so by ``(?U)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of characters, as a Java class each, and which two kinds meet without a space when tokens are joined.
KINDS = {
    "any": r"\s\S", "letter": r"\p{L}", "digit": r"\p{Nd}", "opening": r"(\[{/'\"", "closing": r".,;:!?)\]}%", "apostrophe": "'", "percent": r"%)\]", "number sign": r".\-/", "hyphen": r"\-",
}
CLOSE = (
    ("opening", "any"), ("any", "closing"), ("digit", "digit"), ("digit", "percent"), ("number sign", "digit"), ("hyphen", "letter"),
)
#: Tokens of plain text have these, too; formatted runs keep a space there.
CLOSE_PLAIN = (("any", "apostrophe"), ("letter", "digit"))

# A style that contains the key has the level; the first key counts.
STYLE_LEVELS = {"heading 1": 1, "heading1": 1, "heading 2": 2, "heading2": 2, "heading 3": 3, "heading3": 3, "소제목2": 4, "subtitle2": 4}
LIST_STYLES = ("List Bullet", "List Number")
LIST_TITLE_STYLE = "소제목2"
LIST_TITLE_LABEL = "제목: "
CHAPTER = r"(?iU)^Chapter\s+\d+"
NUMBERED = r"(?U)^\d+(\.\d+)*\s+"
# Lead-ins that a caption loses (the first that fits), and what a model's prompt ends with.
CAPTION_LEADS = ("here is", "here's", "this is", "here are", "here're")
PROMPT_ENDS = ("\nassistant\n", "assistant\n", "assistant:")
HANGUL = "\\uAC00-\\uD7A3"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def left_strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+", "")


def right_strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return strip(text_or_empty(c)) == ""


def split_words(c: Column) -> Column:
    """Runs of characters that are not white space."""
    return F.filter(F.split(text_or_empty(c), r"(?U)\s+"), lambda w: w != "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once: as the argument of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def part_of(array: Column, begin: Column, end: Column) -> Column:
    """The elements of a non-empty stretch, taken one by one (slice copies the whole array first)."""
    return F.transform(F.sequence(begin, end - 1), lambda i: F.get(array, i))


def close_pattern(run_rules: bool = False) -> str:
    """The Java pattern of two characters that meet without a space."""
    return "^(?:" + "|".join(f"[{KINDS[a]}][{KINDS[b]}]" for a, b in (*CLOSE, *(() if run_rules else CLOSE_PLAIN))) + ")$"


#: Stands between texts while they are joined: no character, by Unicode's definition.
SEAM = "\ufdd0"


def close_seams(run_rules: bool = False) -> str:
    """The Java pattern of a seam between two characters that meet without a space."""
    ends = lambda a, b: ("" if a == "any" else f"(?<=[{KINDS[a]}]{SEAM})") + ("" if b == "any" else f"(?=[{KINDS[b]}])")
    return f"{SEAM}(?:" + "|".join(ends(a, b) for a, b in (*CLOSE, *(() if run_rules else CLOSE_PLAIN))) + ")"


def glued(parts: Column, run_rules: bool = False) -> Column:
    """An array's texts, none of them blank or with white space at its ends, as one: with a space between two of them unless
    the characters that meet want none.  The work is linear: all seams are looked at in one pass over the joined text, or, if
    a text has a seam's character in it, one by one."""
    meet = lambda a, b: F.concat(F.substring(a, -1, 1), F.substring(b, 1, 1))
    glue = lambda a, b: F.when(meet(a, b).rlike(close_pattern(run_rules)), F.concat(a, F.lit(""))).otherwise(F.concat(a, F.lit(" ")))
    by_one = lambda p: F.array_join(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.when(b.isNull(), a).otherwise(glue(a, b))), "")
    at_once = lambda p: F.replace(F.regexp_replace(F.array_join(p, SEAM), close_seams(run_rules), ""), F.lit(SEAM), F.lit(" "))
    return bound(parts, lambda p: F.when(F.contains(F.array_join(p, ""), F.lit(SEAM)), by_one(p)).otherwise(at_once(p)))


def join_tokens(tokens: Column, run_rules: bool = False, clean: bool = False) -> Column:
    """All tokens of an array as one text.

    As if they were appended one by one: an empty token changes nothing, a blank one strips what is before it, or is
    stripped by what comes after.  So blanks at the start cancel out in pairs, and outer white space stays where the
    first or last token has any.  clean: the tokens are known to have no white space at their ends.
    """
    some = F.filter(tokens, lambda t: t.isNotNull() & (t != ""))
    if clean:
        return glued(some, run_rules)

    def outer(t: Column, core: Column) -> Column:
        blanks = F.when(F.size(core) == F.size(t), F.lit(0)).otherwise(F.array_position(F.transform(t, lambda x: strip(x) != ""), True) - 1)
        first, last = F.get(t, blanks.cast("int")), F.get(t, F.size(t) - 1)
        lead = F.when(blanks % 2 == 0, F.regexp_extract(first, r"(?U)^(\s*)", 1)).otherwise(F.lit(""))
        tail = F.when(strip(last) != "", F.regexp_extract(last, r"(?U)(\s*)$", 1)).otherwise(F.lit(""))
        whole = F.when(F.size(core) > 0, F.concat(lead, glued(core, run_rules), tail))
        return whole.when(F.size(t) % 2 == 1, last).otherwise(F.lit(""))

    return bound(some, lambda t: bound(F.filter(F.transform(t, strip), lambda x: x != ""), lambda core: outer(t, core)))


def concat_tokens(left: Column, right: Column, run_rules: bool = False) -> Column:
    """Two tokens as one text; an empty one leaves the other as it is, a blank one the other stripped."""
    return join_tokens(F.array(left, right), run_rules)


def normalize_run(c: Column) -> Column:
    """A run's text: no-break space as a space, zero-width space removed, white space runs as one space."""
    whole = strip(F.regexp_replace(F.replace(F.replace(text_or_empty(c), F.lit(" "), F.lit(" ")), F.lit("​"), F.lit("")), r"(?U)\s+", " "))
    # Most runs have nothing of this, which one look tells.
    return F.when(c.rlike("(?U)[\\s\u00a0\u200b]"), whole).otherwise(text_or_empty(c))


def normalize_for_compare(c: Column) -> Column:
    return F.lower(F.regexp_replace(text_or_empty(c), r"(?U)\s+", ""))


def normalize_style(c: Column) -> Column:
    return F.lower(strip(text_or_empty(c)))


def is_list_style(c: Column) -> Column:
    return strip(text_or_empty(c)).isin(*LIST_STYLES)


def join_lines(lines: Column) -> Column:
    """The stripped non-blank texts of an array, a line each."""
    return F.array_join(F.filter(F.transform(lines, lambda t: strip(text_or_empty(t))), lambda t: t != ""), "\n")


def alpha_label(index: Column) -> Column:
    """a to z, aa, ab, ...: the index (from 0) in letters without a zero; up to four of them."""
    letter = lambda n: F.char(F.lit(97) + n.cast("int"))
    label, rest = letter(F.pmod(index, F.lit(26))), index
    for _ in range(3):
        rest = F.floor(rest / 26) - 1
        label = F.when(rest >= 0, F.concat(letter(F.pmod(F.greatest(rest, F.lit(0)), F.lit(26))), label)).otherwise(label)
    return label


def format_list(title: Column, items: Column) -> Column:
    """A list as text: its title line, then a labelled line for every non-blank item; blank ones keep their letter."""
    shown = F.transform(items, lambda item, i: F.when(~is_blank(item), F.concat(alpha_label(i), F.lit(". "), strip(item))))
    head = F.when(~is_blank(title), F.concat(F.lit(LIST_TITLE_LABEL), strip(title)))
    return F.array_join(F.concat(F.array(head), shown), "\n")


def heading_level(style: Column, text: Column, strict: bool = False) -> Column:
    """Level of a heading, null if it is none: by style, else by "Chapter N", else by the depth of its number.

    strict: a lone number at the start (as in "3 files") makes no heading.
    """
    s, t = normalize_style(style), strip(text_or_empty(text))
    level = F.when(F.lit(False), F.lit(None).cast("int"))
    for key, value in STYLE_LEVELS.items():
        level = level.when(F.contains(s, F.lit(key)), F.lit(value))
    number = F.regexp_extract(t, r"(?U)^(\d+(?:\.\d+)*)\s+", 1)
    numbered = number.contains(".") if strict else number != ""
    return level.when(t.rlike(CHAPTER + r"\b"), F.lit(1)).when(numbered, F.least(F.lit(4), F.size(F.split(number, r"\."))))


def clean_heading(text: Column) -> Column:
    """A heading without "Chapter N" and its number."""
    t = F.regexp_replace(strip(text_or_empty(text)), CHAPTER + r"\s+", "")
    return strip(F.regexp_replace(t, NUMBERED, ""))


# The parts of the sentence that tells where a chunk belongs.
INTRO = ("This content is about the section ", ", and more specifically it belongs to ", ", focusing on ", ", under the subsection ", ", with a detailed reference to ")


def section_intro(path: Column) -> Column:
    """The sentence that tells where a chunk belongs, from its titles (at most four)."""
    t = F.transform(F.filter(path, lambda x: x.isNotNull() & (x != "")), clean_heading)
    n, at = F.size(t), lambda i: F.get(t, F.lit(i))
    say = [F.lit(x) for x in INTRO]
    one, two = [say[0], at(0)], [say[0], at(0), say[1], at(1)]
    by_size = {1: one, 2: two, 3: [*two, say[2], at(2)], 4: [*two, say[3], at(2), say[4], at(3)]}
    return F.coalesce(*(F.when(F.least(n, F.lit(4)) == k, F.concat(*parts, F.lit("."))) for k, parts in by_size.items()), F.lit(""))


def media_ids(text: Column, kind: str) -> Column:
    """Distinct ids of the [Image:id] or [Table:id] markers, in order."""
    return F.array_distinct(F.regexp_extract_all(text_or_empty(text), F.lit(rf"\[{kind}:([^\]]+)\]"), F.lit(1)))


def clean_caption(raw: Column) -> Column:
    """A model's answer without its prompt: for each end of a prompt in turn, what follows its first occurrence."""

    def cut(t: Column, end: str) -> Column:
        at = F.position(F.lit(end), t)
        return F.when(at > 0, strip(F.substring(t, at + F.lit(len(end)), F.char_length(t)))).otherwise(t)

    return reduce(cut, PROMPT_ENDS, strip(text_or_empty(raw)))


def normalize_caption(text: Column) -> Column:
    """A caption without its lead-in; null if there is no text."""
    t = strip(text)
    lead = "|".join(CAPTION_LEADS)
    return F.when(text.isNotNull() & (text != ""), F.when(F.lower(t).rlike(f"^(?:{lead})"), F.regexp_replace(t, rf"(?is)^(?:{lead})[:,\-. \t]*", "")).otherwise(t))


def inject_captions(context: Column, captions: Column) -> Column:
    """Appends to every [Image:id] or [image:id] marker its caption from a map of lower-case ids.

    The text is cut at the markers and put together again, so captions are never read as patterns.
    """
    marker = r"\[[Ii]mage:[^\]]+\]"
    parts, marks = F.split(context, marker), F.regexp_extract_all(context, F.lit(marker), F.lit(0))
    shown = F.transform(
        marks, lambda m: F.concat(m, text_or_empty(F.concat(F.lit(" "), F.nullif(F.element_at(captions, F.lower(strip(F.regexp_extract(m, r":([^\]]+)\]", 1)))), F.lit("")))))
    )
    return F.array_join(F.flatten(F.zip_with(parts, shown, lambda p, s: F.array(p, text_or_empty(s)))), "")


def with_image_tokens(text: Column, images: Column) -> Column:
    """A cell's text, followed by the tokens of its images unless all are in it."""
    rids = F.filter(images, lambda r: r.isNotNull() & (r != ""))
    tokens = F.transform(rids, lambda r: F.concat(F.lit("[image:"), r, F.lit("]")))
    t = strip(text_or_empty(text))
    present = F.forall(tokens, lambda k: F.position(k, t) > 0)
    return F.when((t != "") & present, t).otherwise(strip(F.concat_ws(" ", F.nullif(t, F.lit("")), F.nullif(F.array_join(tokens, " "), F.lit("")))))


def html_escape(c: Column) -> Column:
    # The ampersand has to be first.
    pairs = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text_or_empty(c))


def english_tokens(text: Column, bigrams: bool = True) -> Column:
    """Lower-case words of letters, digits and underscores, followed by the pairs of neighbours (a_b)."""
    words = F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit("[A-Za-z0-9_]+"), F.lit(0))
    if not bigrams:
        return words
    pairs = lambda w: F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.concat_ws("_", a, b))
    # The words are bound once, as a lambda's argument.
    return F.get(F.transform(F.array(words), lambda w: F.concat(w, F.when(F.size(w) >= 2, pairs(w)).otherwise(F.array().cast("array<string>")))), F.lit(0))


def korean_tokens(text: Column) -> Column:
    """White-space words, each followed by the pairs of its neighbouring Hangul syllables."""

    def of(word: Column) -> Column:
        h = F.regexp_replace(word, f"[^{HANGUL}]", "")
        n = F.char_length(h)
        pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(h, i, F.lit(2)))
        return F.concat(F.array(word), F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>")))

    return F.flatten(F.transform(split_words(text), of))


def tokens(text: Column, language: str = "en") -> Column:
    """Tokens by language: en, ko, or auto (ko if there is any Hangul)."""
    if language == "en":
        return english_tokens(text)
    if language == "ko":
        return korean_tokens(text)
    if language != "auto":
        raise ValueError(f"no tokens for language {language!r}")
    return F.when(text_or_empty(text).rlike(f"[{HANGUL}]"), korean_tokens(text)).otherwise(english_tokens(text))


def safe_version(c: Column) -> Column:
    """A version as part of a name: other characters than letters, digits, ., _ and - become _; empty is v1."""
    return F.coalesce(F.nullif(F.regexp_replace(strip(text_or_empty(c)), r"[^a-zA-Z0-9._-]", "_"), F.lit("")), F.lit("v1"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def cell_at(matrix: Column, row: Column, column: Column) -> Column:
    """A cell's stripped text; empty out of range."""
    return strip(text_or_empty(F.get(F.get(matrix, row), column)))
