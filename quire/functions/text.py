"""Column expressions over text fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.arrays import bind

# A quoted string with its backslash escapes, or a run of text outside quotes.
_LITERAL_TOKEN = r"""('[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++)"""
_HEX_ESCAPE = r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})"


def parse_list_literal(text: Column) -> Column:
    """A list literal such as ``['A', "O'Neil", None]`` as an array of strings; null when it does not parse.

    The JSON reader takes both kinds of quotes. Only ``\\xNN`` escapes inside quotes and ``None`` outside them
    need rewriting first.
    """
    is_quoted = lambda token: token.startswith("'") | token.startswith('"')
    tokens = F.transform(
        F.regexp_extract_all(text, F.lit(_LITERAL_TOKEN), 1),
        lambda token: F.when(is_quoted(token), F.regexp_replace(token, _HEX_ESCAPE, r"$1\\u00$2"))
        .otherwise(F.regexp_replace(token, r"\bNone\b", "null")))
    needs_rewrite = text.contains("None") | text.contains("\\x")
    rewritten = F.when(needs_rewrite, F.array_join(tokens, "")).otherwise(text)
    return F.from_json(rewritten, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})


def count_unparsed(text: Column, parsed: Column) -> Column:
    """Aggregate: how many non-null texts did not parse."""
    return F.count_if(text.isNotNull() & parsed.isNull())


def split_multivalue(text: Column, sep: str = "|", null_as_empty: bool = False) -> Column:
    """Text with separators as an array; null stays null, or becomes ``[""]`` on request."""
    return F.split(F.coalesce(text, F.lit("")) if null_as_empty else text, f"\\Q{sep}\\E")


#: Form of a text, and the pattern that reads it.
DATE_FORMATS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$", "yyyyMMdd": r"^\d{8}$", "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "dd.MM.yyyy": r"^\d{2}\.\d{2}\.\d{4}$", "yyyy-MM": r"^\d{4}-\d{2}$", "yyyy": r"^\d{4}$",
}
#: Whole days only; a month or a year alone has to be asked for.
DAYS = ("yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "dd.MM.yyyy")


def parse_date(text: Column, formats: tuple[str, ...] = DAYS) -> Column:
    """The date of a text in one of the formats, the first that it has the form of; null when it has none or is no day
    of the calendar. With ``yyyy-MM`` or ``yyyy`` among the formats a month or year stands for its first day."""
    trimmed = F.trim(text)
    return F.coalesce(*[F.when(trimmed.rlike(DATE_FORMATS[form]), F.try_to_date(trimmed, form)) for form in formats])


def rejected_text(text: Column, parsed: Column) -> Column:
    """The text that did not parse, null where it did or was null: a column to keep beside the parsed one."""
    return F.when(parsed.isNull(), text)


def derive_email(name: Column, fallback_prefix: str, domain: str = "gmail.com") -> Column:
    """First and second word of the name at the domain; a one-word name gets the prefix instead."""
    at_domain = lambda *parts: F.concat(*parts, F.lit(f"@{domain}"))
    words = F.filter(F.split(name, r"(?U)\s+"), lambda word: word != "")
    return bind(words, lambda w: F.when(F.size(w) > 1, at_domain(F.get(w, 0), F.get(w, 1)))
                .otherwise(at_domain(F.lit(fallback_prefix), F.get(w, 0))))


# The keyword list of the document collection.
KEYWORDS = [
    "MACHINE LEARNING", "DEEP LEARNING", "BIG DATA", "GPU", "HTML", "PYTHON", "C++",
    "JAVA", "UI", "UX", "FLUTTER", "NEO4J", "MONGODB", "SPARK",
]


def tag_keywords(text: Column, vocabulary: list[str] = KEYWORDS) -> Column:
    """Words of the vocabulary (upper case) that the whole text contains, in vocabulary order.

    A word counts where no letter or digit stands right before or behind it, so JAVA is not in JAVASCRIPT.
    """
    inside = r"[\p{L}\p{N}]"
    def found(upper, word):
        return upper.contains(word) & upper.rlike(rf"(?<!{inside})\Q{word}\E(?!{inside})")
    return bind(F.upper(text), lambda upper: F.array_compact(
        F.array(*[F.when(found(upper, word), F.lit(word)) for word in vocabulary])))
