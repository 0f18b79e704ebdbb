"""Column expressions on text: stripping, padding, dates, counts, tokens, prompts, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daystack.functions import tokens

#: White space as Unicode has it, with the separators U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"


def strip(c: Column | str) -> Column:
    """Null as empty, without white space of any kind at either end."""
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def zero_pad(c: Column, width: int = 2) -> Column:
    """Zeros to the left up to ``width``; longer values stay whole."""
    c = c.cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def iso_date(year: Column, month: Column, day: Column) -> Column:
    """yyyy-mm-dd as text, whether the calendar has it or not."""
    return F.concat_ws("-", year.cast("string"), zero_pad(month), zero_pad(day))


def calendar_date(text: Column) -> Column:
    """The date of a key such as 2024-1-5 or 2024-01-05; null where the calendar has none."""
    return F.try_to_date(text, "yyyy-M-d")


def composite_key(year: Column, month: Column, article_id: Column) -> Column:
    return F.concat_ws("_", year, month, article_id)


def clean_count(text: Column) -> Column:
    """A whole number written with thousands separators, or null."""
    return F.regexp_replace(text, ",", "").try_cast("bigint")


def strip_fences(text: Column) -> Column:
    """A code block's content: without the opening fence (with its language) and the closing one.

    On a single line only the fence's own marks go.
    """
    text = strip(text)
    opened = F.when(text.startswith("```"), F.when(F.instr(text, "\n") > 0, F.regexp_replace(text, "^[^\\n]*\\n", "")).otherwise(F.regexp_replace(text, "^`+", ""))).otherwise(text)
    return strip(F.when(opened.endswith("```"), F.regexp_replace(opened, "```$", "")).otherwise(opened))


def token_count(text: Column, tokenizer: str = "") -> Column:
    """Tokens of a ``tokenizer`` (see ``tokens``); without one, by the rule of four code points each."""
    if tokenizer and tokens.usable(tokenizer):
        return tokens.count(text, tokenizer)
    return (F.length(F.coalesce(text, F.lit(""))) / tokens.PER_TOKEN).cast("bigint")


def truncate_tokens(text: Column, most: int, tokenizer: str = "") -> Column:
    """The first ``most`` tokens, counted in the same way."""
    if tokenizer and tokens.usable(tokenizer):
        return tokens.cut(text, most, tokenizer)
    return F.substring(F.coalesce(text, F.lit("")), 1, tokens.PER_TOKEN * most)


#: Our own wording; a provider may bring another.
CLASSIFY_PROMPT = ("Does this article state how many pilgrims came on a day? Answer true or false.\nTitle: ", "\nText: ", "")
EXTRACT_PROMPT = ("Return JSON with day, pilgrim_count and other_metrics from this text, within ", " tokens.\nText: ", "")


def classify_prompt(title: Column, content: Column, most_tokens: int, tokenizer: str = "") -> Column:
    a, b, c = CLASSIFY_PROMPT
    return F.concat(F.lit(a), F.coalesce(title, F.lit("")), F.lit(b), truncate_tokens(content, most_tokens, tokenizer), F.lit(c))


def extract_prompt(content: Column, most_tokens: int, tokenizer: str = "") -> Column:
    a, b, c = EXTRACT_PROMPT
    return F.concat(F.lit(a), F.lit(str(most_tokens)), F.lit(b), truncate_tokens(content, most_tokens, tokenizer), F.lit(c))


def render(template: str, **values: Column) -> Column:
    """A template's {names} replaced by columns, in one pass; doubled braces are single ones."""
    parts: list[Column] = []
    rest = template
    while True:
        at = min((k for k in (rest.find("{"), rest.find("}")) if k >= 0), default=-1)
        if at < 0:
            parts.append(F.lit(rest))
            return F.concat(*parts)
        parts.append(F.lit(rest[:at]))
        if rest[at : at + 2] in ("{{", "}}"):
            parts.append(F.lit(rest[at]))
            rest = rest[at + 2 :]
        elif rest[at] == "{" and (end := rest.find("}", at)) > 0:
            parts.append(F.coalesce(values[rest[at + 1 : end]].cast("string"), F.lit("")))
            rest = rest[end + 1 :]
        else:
            raise ValueError(f"a single brace in the template: {rest[at:at + 20]!r}")


def request_tokens(prompt: Column, overhead: int, tokenizer: str = "") -> Column:
    """What a request is estimated to take: its rendered prompt's tokens and a fixed part."""
    return token_count(prompt, tokenizer) + F.lit(overhead)


def custom_id(article_id: Column, kind: str | Column) -> Column:
    return F.concat(article_id.cast("string"), F.lit("-"), F.lit(kind) if isinstance(kind, str) else kind)


#: Endings of request ids, by kind; the short forms are older.
ENDINGS = {"classification": ("classification", "classify"), "extraction": ("extraction", "extract")}


def id_matches(c: Column, kind: str) -> Column:
    return c.rlike(f"-({'|'.join(ENDINGS[kind])})$")


def article_of(c: Column, kind: str) -> Column:
    """The article's id in a request id of this kind; null in others."""
    return F.when(id_matches(c, kind), F.regexp_replace(c, f"-({'|'.join(ENDINGS[kind])})$", ""))


def enqueued_limit(message: Column) -> Column:
    """The limit that an error message states, if it is over 0."""
    found = F.regexp_extract(message, r"Limit:\s*([\d,]+)\s+enqueued", 1)
    n = clean_count(F.when(found != "", found))
    return F.when(n > 0, n)


def label(text: Column) -> Column:
    """true, false, or null for a response that says nothing."""
    said = F.lower(strip(text))
    return F.when(text.isNull() | (said == ""), F.lit(None).cast("string")).when(said == "true", "true").otherwise("false")
