"""Page and draft text: HTML to text, usability gates, wording checks, draft metrics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from prospectra.functions.identity import _col, let, none_if_blank
from prospectra.functions.markup import tag_events, visible_text
from prospectra.functions.patterns import replace_longest

# Control characters a text store refuses (tab, LF and CR are kept).
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
BLANKS = r"[\s\x{a0}]+"

# An address inside a mailto link.
MAILTO = r"(?i)mailto:\s*([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,24})"

# Phrases of a block, challenge, error or parked page.
BLOCK_MARKERS = (
    r"(?i)(?:\b40[0-9]\b[\s-]*(?:forbidden|unauthorized|bad request|not found|page)"
    r"|\bpage not found\b|\bnot found\b|\b404 page\b|dns resolution error|please enable cookies"
    r"|error 10\d\d\b|ray id:|forbidden|unauthorized|access (?:to this page )?is (?:forbidden|denied)"
    r"|access denied|attention required|checking your browser|just a moment|ddos protection"
    r"|request blocked|are you a robot|captcha|security check|verify you are human|not acceptable"
    r"|service unavailable|site can'?t be reached|account suspended|website firewall|not configured"
    r"|domain (?:for sale|is parked)|under construction)"
)

# Closing lines, payment words, promises.
SIGN_OFF = (
    r"(?i)^(thanks|thank you|best|best regards|regards|kind regards|warm regards|warmly|sincerely"
    r"|cheers|all the best|talk soon)\b[\s,.!]*$"
)
PAYMENT_TERMS = (
    r"(?i)up[\s-]?front|\bpay(?:s|ing)? only\b|\bonly pay|\bpay(?:s|ing)?[\s-]per\b"
    r"|\bper[\s-](?:qualified[\s-])?lead\b|risk[\s-]?free|\bno risk\b|money[\s-]?back|refund"
)
PAYMENT_OR_PROMISE = (
    r"(?i)up[\s-]?front|ad spend|\bpay(?:s|ing)? only\b|\bonly pay|\bpay(?:s|ing)?[\s-]per\b"
    r"|\bper[\s-](?:qualified[\s-])?lead\b|risk[\s-]?free|\bno risk\b|guarantee|money[\s-]?back"
    r"|refund|free trial"
)
BRACKETED = r"\[[^\]\n]{1,60}\]|\{\{[^}\n]{1,60}\}\}|\{[^}\n]{1,60}\}|<[^>\n]{1,60}>"
HTML_ENTITY = r"&(?:[a-zA-Z]{2,8}|#\d{1,6}|#x[0-9a-fA-F]{1,6});"
MARKDOWN = r"(?m)(?:\*\*[^*\n]+\*\*|^#{1,6}\s|^\s*[-*]\s+\S|\[[^\]\n]+\]\([^)\n]+\))"

# Letters whose Unicode name does not begin with LATIN.
FOREIGN_LETTER = r"[[\p{L}&&[^\p{IsLatin}]]ªºＡ-Ｚａ-ｚ]"
FOREIGN = FOREIGN_LETTER + r"|(?<=" + FOREIGN_LETTER + r")\p{Mn}"


def strip_controls(text: Column | str, replacement: str = " ") -> Column:
    """Control characters replaced; tab, newline and carriage return survive."""
    return F.regexp_replace(_col(text), CONTROL, replacement)


def code_point(code: Column) -> Column:
    """The character of a decimal code point; a number that is none stays a reference."""
    number = code.cast("int")
    known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(known, char).otherwise(F.concat(F.lit("&#"), code, F.lit(";")))


def decode_entities(text: Column | str) -> Column:
    """The named entities page copy uses, plus their decimal forms."""
    c = F.regexp_replace(_col(text), "&#0?39;|&apos;|&rsquo;", "'")
    c = F.regexp_replace(c, "&quot;|&ldquo;|&rdquo;", '"')
    c = F.regexp_replace(c, "&#0?38;|&amp;", "&")
    c = F.regexp_replace(c, "&nbsp;", " ")
    c = F.regexp_replace(c, "&lt;", "<")
    c = F.regexp_replace(c, "&gt;", ">")
    return let(c, lambda t: F.when(~F.contains(t, F.lit("&#")), t).otherwise(F.aggregate(
        F.array_distinct(F.regexp_extract_all(t, F.lit(r"&#(\d{1,7});"), F.lit(1))), t,
        lambda acc, code: F.replace(
            acc, F.concat(F.lit("&#"), code, F.lit(";")), code_point(code)
        ),
    )))


def mailto_addresses(html: Column | str) -> Column:
    """Distinct addresses of the page's mailto links, in page order."""
    return F.array_distinct(
        F.transform(F.regexp_extract_all(_col(html), F.lit(MAILTO), F.lit(1)), F.lower)
    )


def html_to_text(html: Column | str) -> Column:
    """Visible text of a page; up to ten mailto addresses go in front."""
    return events_to_text(tag_events(strip_controls(html), keys=()), mailto_addresses(html))


def events_to_text(events: Column, linked: Column) -> Column:
    """The same of a page's tag events and its linked addresses."""
    first = F.slice(linked, 1, 10)
    prefix = F.when(F.size(first) > 0, F.concat(F.array_join(first, " "), F.lit(" "))).otherwise("")
    body = F.regexp_replace(visible_text(events), r"&nbsp;", " ")
    body = F.regexp_replace(body, "&amp;", "&")
    body = F.regexp_replace(body, "&(?:#39|rsquo|apos);", "'")
    body = F.regexp_replace(body, "&(?:quot|ldquo|rdquo);", '"')
    return F.concat(prefix, F.trim(F.regexp_replace(body, BLANKS, " ")))


def is_usable_page(status: Column, body: Column, text: Column) -> Column:
    """A 2xx/3xx body over 500 characters, or any answer whose text reads like a page."""
    reads_like_page = (F.length(text) >= 400) & ~F.substring(text, 1, 600).rlike(BLOCK_MARKERS)
    return F.coalesce(
        (F.length(body) > 500) & (status.between(200, 399) | reads_like_page), F.lit(False)
    )


def content_error(content: Column, minimum: int = 300) -> Column:
    """Why a page text is not kept: empty or too short; NULL when it is fine."""
    n = F.length(F.trim(F.coalesce(content, F.lit(""))))
    return F.when(n == 0, F.lit("empty content")).when(
        n < minimum, F.concat(F.lit("content too short ("), n.cast("string"), F.lit(" chars)"))
    )


def _first_match(text: Column, pattern: str) -> Column:
    return none_if_blank(F.regexp_extract(F.coalesce(text, F.lit("")), f"({pattern})", 1))


def find_payment_terms(text: Column | str) -> Column:
    """First payment term, or NULL."""
    return _first_match(_col(text), PAYMENT_TERMS)


def find_payment_or_promise(text: Column | str) -> Column:
    """First payment term or promise, or NULL."""
    return _first_match(_col(text), PAYMENT_OR_PROMISE)


def _is_placeholder(match: Column) -> Column:
    token = F.trim(F.regexp_replace(match, r"^(?:\{\{|[\[{<])|(?:\}\}|[\]}>])$", ""))
    words = F.split(token, r"\s+")
    named = token.contains("_") & F.replace(token, F.lit("_"), F.lit("")).rlike(r"^[\p{L}\p{N}]+$")
    shouted = (token == F.upper(token)) & (token != F.lower(token))
    titled = F.forall(words, lambda w: w.rlike(r"^\p{Lu}"))
    return (token != "") & (F.size(words) <= 3) & (named | shouted | titled)


def find_placeholder(text: Column | str) -> Column:
    """First bracketed token somebody was meant to fill in, or NULL; prose asides pass."""
    found = F.regexp_extract_all(_col(text), F.lit(BRACKETED), F.lit(0))
    return F.get(F.filter(found, _is_placeholder), F.lit(0))


def _lines(text: Column, trimmed: bool) -> Column:
    lines = F.split(F.rtrim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+$", "")), "\r?\n")
    if trimmed:
        lines = F.transform(lines, lambda ln: F.trim(ln))
    return F.filter(lines, lambda ln: F.trim(ln) != "")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def find_sign_off(body: Column | str) -> Column:
    """The closing a text ends with (alone, or followed by a short name line), or NULL."""
    lines = _lines(_col(body), True)
    n = F.size(lines)
    last, prev = F.get(lines, n - 1), F.get(lines, n - 2)
    name_line = (F.size(_words(last)) <= 3) & ~F.right(last, F.lit(1)).isin(".", "?", "!")
    return F.when((n > 1) & last.rlike(SIGN_OFF), last).when(
        (n > 2) & prev.rlike(SIGN_OFF) & name_line, F.concat(prev, F.lit("\n"), last)
    )


def ends_terminated(body: Column | str) -> Column:
    """True when the last real line ends in a full stop, question or exclamation mark."""
    lines = _lines(_col(body), False)
    n = F.size(lines)
    last = F.get(lines, n - 1)
    judged = F.when((n > 1) & (F.size(_words(last)) <= 3), F.get(lines, n - 2)).otherwise(last)
    tail = F.regexp_replace(F.coalesce(judged, F.lit("")), r"\s+$", "")
    tail = F.regexp_replace(tail, "[\"')\\]”’]+$", "")
    return F.right(tail, F.lit(1)).isin(".", "!", "?")


def foreign_characters(text: Column | str) -> Column:
    """Sorted distinct letters outside the Latin script, with marks attached to them."""
    found = F.regexp_extract_all(_col(text), F.lit(FOREIGN), F.lit(0))
    return F.array_sort(F.array_distinct(found))


def joined_failures(pairs: list[tuple[Column, str]]) -> Column:
    """Names of the conditions that hold, in the order given."""
    named = F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs])
    return F.filter(named, lambda x: x.isNotNull())


def draft_metrics(subject: Column, body: Column, business_name: Column | None = None) -> dict[str, Column]:
    """Measurements of a drafted mail, one column each."""
    subject, body = F.coalesce(subject, F.lit("")), F.coalesce(body, F.lit(""))
    text = F.concat(subject, F.lit("\n"), body)
    mentions = F.lit(None).cast("boolean")
    if business_name is not None:
        mentions = F.when(
            F.coalesce(business_name, F.lit("")) != "",
            F.contains(F.lower(text), F.lower(business_name)),
        )
    return {
        "subject_chars": F.length(subject),
        "body_chars": F.length(body),
        "body_words": F.size(_words(body)),
        "paragraphs": F.size(F.filter(F.split(body, r"\n\s*\n"), lambda p: F.trim(p) != "")),
        "ends_terminated": ends_terminated(body),
        "foreign_chars": foreign_characters(text),
        "html_entities": F.array_sort(
            F.array_distinct(F.regexp_extract_all(text, F.lit(HTML_ENTITY), F.lit(0)))
        ),
        "has_markdown": body.rlike(MARKDOWN),
        "has_question": F.contains(body, F.lit("?")),
        "has_sign_off": find_sign_off(body).isNotNull(),
        "mentions_business": mentions,
    }


def contains_token(text: Column, tag: str) -> Column:
    """True when ``tag`` stands in the text as a whole alphanumeric token."""
    quoted = "".join(f"\\{ch}" if not ch.isalnum() else ch for ch in tag)
    return text.rlike(f"(?:^|[^A-Za-z0-9]){quoted}(?:[^A-Za-z0-9]|$)")


def keyword_route(prompt: Column | str, routes: dict[str, list[str]], default: str) -> Column:
    """Route with the most keyword hits, earlier routes winning ties; ``default`` at zero."""
    low = F.lower(_col(prompt))
    hits = F.array(*[
        sum((F.contains(low, F.lit(k)).cast("int") for k in words), F.lit(0))
        for words in routes.values()
    ])
    names = F.array(*[F.lit(n) for n in routes])
    best = F.array_max(hits)
    at = F.array_position(hits, best).cast("int")
    return F.when(best > 0, F.element_at(names, at)).otherwise(F.lit(default))


# Routing keywords by tier, in tie-break order.
ROUTES = {
    "frontier": ["research", "analyze", "compare", "evaluate", "optimize", "prove", "theorem", "complex"],
    "code": ["code", "function", "algorithm", "python", "javascript", "sql", "regex", "bug", "implement"],
    "mid": ["explain", "summarize", "write", "create", "design"],
    "cheap": ["typo", "format", "spell", "grammar", "define", "what is", "who is", "when is"],
}


def as_text(value: Column, kind: str) -> Column:
    """A value as text for a string-only field: lists joined, booleans spelled, NULL empty."""
    if kind == "array":
        return F.array_join(F.coalesce(value, F.array()), "; ")
    if kind == "boolean":
        return F.when(value, "true").when(~value, "false").otherwise("")
    if kind == "double":
        shown = F.regexp_replace(F.format_string("%.6f", value), r"\.?0+$", "")
        return F.coalesce(F.when(value.isNotNull(), shown), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))


def non_empty_map(fields: dict[str, Column]) -> Column:
    """A map of the fields whose text is not empty."""
    pairs = [part for name, value in fields.items() for part in (F.lit(name), value)]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v != "")


def replace_known_ids(text: Column | str, names: dict[str, str]) -> Column:
    """Every known id replaced by its display name, longest id first, in one pass over the text."""
    return replace_longest(_col(text), names)
