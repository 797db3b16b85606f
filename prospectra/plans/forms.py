"""Contact forms on stored pages: fields, roles, traps, verdicts; answers to submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.identity import host, resolve_url
from prospectra.functions.markup import opened, source_of, tag_events
from prospectra.functions.regex import before
from prospectra.functions.text import decode_entities
from prospectra.operators.stage import staged
from prospectra.operators.topk import first_k

# Field roles, first match wins.
FIELD_ROLES = (
    ("first_name", r"(?i)(?:^|[^a-z])(?:first[\s_-]*name|fname|given)|\binput_\d+\.3$|^first$"),
    ("last_name", r"(?i)(?:^|[^a-z])(?:last[\s_-]*name|lname|surname|family)|\binput_\d+\.6$|^last$"),
    ("email", r"(?i)e-?mail"),
    ("phone", r"(?i)phone|mobile|cell|telephone|\btel\b"),
    ("company", r"(?i)company|business[\s_-]*name|organi[sz]ation|\bbrand\b"),
    ("message", r"(?i)message|comment|question|inquiry|enquiry|details|tell[\s_-]*us|how[\s_-]*can[\s_-]*we|notes?\b"),
    ("zip", r"(?i)\bzip\b|postal|post[\s_-]*code"),
    ("city", r"(?i)\bcity\b|\btown\b"),
    ("state", r"(?i)\bstate\b|\bprovince\b"),
    ("location", r"(?i)where\s+(?:are|is)\s+you|your\s+location|\blocation\b|\barea\b"),
    ("subject", r"(?i)subject|topic|regarding"),
    ("full_name", r"(?i)\bname\b|your[\s_-]*name"),
)
# Words for somebody else's details, trap names and wrappers, other kinds of forms.
NOT_THE_SENDER = (
    r"(?i)\b(?:dogs?|pets?|pup|pups|puppy|puppies|animals?|breed|cats?|kennel|user|screen|file|domain"
    r"|furry|companion)\b"
)
TRAP_NAME = (
    r"(?i)(?:^|[_-])(?:hp|honeypot|honey|bot|trap|url|website|fax|comment_?field)(?:[_-]|$)|^ak_|_hp_"
    r"|\bhoneypot\b"
)
TRAP_WRAPPER = (
    r"(?i)gfield--type-honeypot|gform_validation_container"
    r"|\b(?:honeypot|hp-?field|visually-hidden-field|screen-reader-only-input)\b"
    r"|(?:display\s*:\s*none|visibility\s*:\s*hidden|left\s*:\s*-\d{4,}px)"
)
NOT_A_CONTACT_FORM = (
    r"(?i)\b(?:search|login|log-?in|signin|sign-?in|register|cart|checkout|password|newsletter|subscribe"
    r"|optin|opt-?in|mailpoet|zcampaign|maillist-manage|mc4wp|klaviyo)\b"
)
# Wording of a received and of a refused submission.
CONFIRMED = (
    r"(?i)\b(?:thank you|thanks for (?:your|reaching|contacting|getting)"
    r"|message (?:has been )?(?:sent|received|submitted)|we(?:'| ha)ve received"
    r"|we(?:'ll| will) (?:be in touch|get back|contact you|reach out)"
    r"|submission (?:was )?(?:successful|received)|form (?:was )?submitted|successfully submitted"
    r"|your (?:request|inquiry|message) (?:has been|was) (?:sent|received))"
)
REFUSED = (
    r"(?i)\b(?:there was a problem|errors? (?:were|was) found|please (?:correct|complete|fill|enter|check)"
    r"|this field is required|required field|invalid (?:email|entry|input)|could not be (?:sent|submitted)"
    r"|please try again)"
)
CONTROLS = ("input", "textarea", "select")
#: Characters in front of a control that may show it hidden.
WRAPPER_REACH = 400
DELIVERED = ("sent", "rejected", "unknown")


def attribute(values: Column, name: str) -> Column:
    """One attribute of a tag, entities decoded; NULL when absent."""
    return decode_entities(F.try_element_at(values, F.lit(name)))


def forms_of(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per form of a page: its number, tag, attributes, body, and the open tags inside.

    A form that is never closed reaches to the end of the page.
    """
    rest = [c for c in pages.columns if c != html]
    read = staged(pages, {"_events": tag_events(html, ("open", "close"), ("form", "label", *CONTROLS))})
    heads = F.filter("_events", lambda e: (e["kind"] == "open") & (e["name"] == "form") & (e["form"] >= 0))
    tops = F.filter(heads, lambda e: e["start"] == F.array_min(F.transform(F.filter(heads, lambda x: x["form"] == e["form"]), lambda x: x["start"])))
    one = read.select(*rest, html, "_events", F.explode(tops).alias("_f"))
    inside = F.filter("_events", lambda e: (e["form"] == F.col("_f.form")) & (e["start"] >= F.col("_f.stop")))
    end = F.coalesce(F.array_min(F.transform(F.filter(inside, lambda e: (e["kind"] == "close") & (e["name"] == "form")), lambda e: e["start"])), F.length(html))
    body = F.substring(F.col(html), F.col("_f.stop") + 1, end - F.col("_f.stop"))
    return one.select(
        *rest, F.col("_f.form").alias("form_index"), source_of(F.col(html), F.col("_f")).alias("tag"), F.col("_f.values").alias("attrs"),
        body.alias("body"), F.col("_f.stop").alias("body_start"), opened(inside, "label", *CONTROLS).alias("tags"),
    )


def _label_for(labels: Column, field_id: Column) -> Column:
    return F.element_at(
        F.concat(F.array(F.lit(None).cast("string")),
                 F.transform(F.filter(labels, lambda x: x["id"] == field_id), lambda x: x["text"])), -1
    )


def fields_of(forms: DataFrame) -> DataFrame:
    """One row per named control with its label, kind, role and whether it is a trap."""
    labels = F.transform(F.filter("tags", lambda e: e["name"] == "label"), lambda e: F.struct(
        attribute(e["values"], "for").alias("id"),
        F.trim(F.regexp_replace(decode_entities(F.coalesce(e["text"], F.lit(""))), r"\s+", " ")).alias("text"),
    ))
    labels = F.filter(labels, lambda x: x["id"].isNotNull() & (x["text"] != ""))
    keep = [c for c in forms.columns if c not in ("tag", "attrs", "body", "body_start", "tags")]
    raw = forms.withColumn("_labels", labels).select(
        *keep, "body", "body_start", "_labels", F.posexplode(F.filter("tags", lambda e: e["name"] != "label")).alias("field_pos", "_m")
    )
    at = F.col("_m.start") - F.col("body_start")
    raw = staged(raw, {
        "tag": F.col("_m.name"), "_v": F.col("_m.values"), "_a": F.substring(F.col("body"), at + 1, F.col("_m.stop") - F.col("_m.start")),
        "_ctx": before(F.col("body"), at + 1, WRAPPER_REACH),
    }, ("body", "body_start", "_m"))
    a, v = F.col("_a"), F.col("_v")
    named = staged(raw, {
        "name": attribute(v, "name"), "field_id": attribute(v, "id"), "placeholder": attribute(v, "placeholder"),
        "type": F.lower(F.coalesce(F.nullif(attribute(v, "type"), F.lit("")), F.col("tag"))),
        "required": F.map_contains_key(v, "required") | F.coalesce(F.lower(F.try_element_at(v, F.lit("aria-required"))) == "true", F.lit(False)),
    }, ("_v",)).filter(F.coalesce("name", F.lit("")) != "")
    named = staged(named, {"label": _label_for(F.col("_labels"), F.col("field_id"))}, ("_labels",))
    shown = F.array(F.col("label"), F.col("placeholder"))
    hay = F.filter(F.array("label", "placeholder", "name", "field_id"), lambda x: F.coalesce(x, F.lit("")) != "")
    foreign = F.exists(F.filter(shown, lambda x: x.isNotNull()), lambda x: x.rlike(NOT_THE_SENDER))
    by_type = F.when(F.col("type") == "email", "email").when(F.col("type") == "tel", "phone")

    def mentions(pattern: str) -> Column:
        return F.exists(hay, lambda x: x.rlike(pattern))

    role = F
    for name, pattern in FIELD_ROLES:
        hit = mentions(pattern)
        if "name" in name:
            role = role.when(hit & ~foreign, name)
        elif name == "message":
            role = role.when(hit, name)
        else:
            role = role.when(hit, F.coalesce(by_type, F.lit(name)))
    trap = (F.col("type") != "hidden") & (
        F.col("name").rlike(TRAP_NAME) | F.coalesce(F.col("field_id"), F.lit("")).rlike(TRAP_NAME)
        | ((F.col("type") == "text") & a.rlike(r"(?i)autocomplete\s*=\s*[\"']new-password"))
        | F.col("_ctx").rlike(TRAP_WRAPPER)
    )
    return staged(named, {
        "role": F.coalesce(role.otherwise(F.lit(None)), by_type), "is_trap": trap
    }, ("_a", "_ctx"))


def classify(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    """One row per form: key, action, field count, verdict and the reason when it is no contact form."""
    forms = forms_of(pages.select(key, url, html), html)
    fields = fields_of(forms.select(key, "form_index", "body", "body_start", "tags"))
    counted = ~F.col("type").isin("hidden", "submit", "button") & ~F.col("is_trap")
    per_form = fields.groupBy(key, "form_index").agg(
        F.count(F.lit(1)).alias("n_fields"),
        F.max(F.when(counted & (F.col("role") == "email"), 1)).alias("_email"),
        F.max(F.when(counted & (F.col("role") == "message"), 1)).alias("_message"),
        F.max(F.when(F.col("type").contains("file"), 1)).alias("_file"),
        F.count_if("is_trap").alias("traps"),
    )
    marker, values = F.col("tag"), F.col("attrs")
    method = F.lower(F.coalesce(attribute(values, "method"), F.lit("get")))
    action = attribute(values, "action")
    target = F.when(
        F.coalesce(action, F.lit("")).rlike("^(?:#|$)"), resolve_url(F.lit(""), url)
    ).otherwise(resolve_url(action, url))
    reason = (
        F.when(marker.rlike(NOT_A_CONTACT_FORM), "not a contact form (search/newsletter/auth)")
        .when(method != "post", "form is GET, not a submission endpoint")
        .when(F.col("_email").isNull(), "no email field")
        .when(F.col("_message").isNull(), "no message field (likely a newsletter opt-in)")
        .when(F.col("_file").isNotNull(), "file upload field")
        .when(F.col("body").rlike("(?i)recaptcha|hcaptcha|turnstile"), "captcha present")
    )
    form_key = F.coalesce(
        F.nullif(attribute(values, "id"), F.lit("")), F.concat(F.lit("form-"), F.col("form_index").cast("string"))
    )
    return forms.join(per_form, [key, "form_index"], "left").select(
        key, url, "form_index", form_key.alias("form_key"), target.alias("action_url"),
        F.coalesce("n_fields", F.lit(0)).alias("n_fields"), F.coalesce("traps", F.lit(0)).alias("traps"),
        reason.isNull().alias("ok"), reason.alias("reason"),
    )


def best_form(classified: DataFrame, keys: list[str]) -> DataFrame:
    """The usable form with the most fields per group."""
    usable = classified.filter(F.col("ok") & F.col("action_url").isNotNull())
    return first_k(usable, keys, [F.col("n_fields").desc(), F.col("form_index")], 1).drop("rank")


def read_response(status: Column, text: Column, head: int | None = None, longest_note: int | None = None) -> dict[str, Column]:
    """Outcome and note of a submission's answer; an error phrase beats a confirmation.

    ``head`` reads only the first characters of an answer, ``longest_note`` cuts the note.
    """
    whole = F.coalesce(text, F.lit(""))
    head = whole if head is None else F.left(whole, F.lit(head))
    cut = lambda c: c if longest_note is None else F.left(c, F.lit(longest_note))
    code = status.cast("string")
    outcome = F.when(status == 0, "blocked").when(status.isin(403, 429) | (status >= 500), "blocked") \
        .when(head.rlike(REFUSED), "rejected").when(head.rlike(CONFIRMED), "sent").otherwise("unknown")
    note = (
        F.when(status == 0, "no response")
        .when(status.isin(403, 429) | (status >= 500), F.concat(F.lit("HTTP "), code))
        .when(head.rlike(REFUSED), cut(F.regexp_extract(head, f"({REFUSED})", 1)))
        .when(head.rlike(CONFIRMED), cut(F.regexp_extract(head, f"({CONFIRMED})", 1)))
        .otherwise(F.concat(F.lit("HTTP "), code, F.lit(", no confirmation or error text")))
    )
    return {"outcome": outcome, "note": note}


def targets(businesses: DataFrame, pages: DataFrame, attempts: DataFrame,
            retry_unknown: bool = False, max_pages: int = 4) -> DataFrame:
    """The first ``max_pages`` pages with a form of businesses without an address, contact pages first, not attempted before.

    An unknown outcome is final unless ``retry_unknown`` makes just those eligible again.
    """
    tried = attempts.filter(F.col("outcome") != "unknown") if retry_unknown else attempts
    wanted = businesses.filter((F.col("qc_status") != "REJECTED") & F.col("contact_email").isNull()) \
        .join(tried.select(F.col("business_id").alias("id")), "id", "left_anti")
    order = [
        (F.col("page_kind") == "contact").desc_nulls_last(), F.col("page_kind").isNotNull().desc(),
        F.col("fetched_at").desc_nulls_last(), F.col("page_url"),
    ]
    shown = pages.filter(F.col("lead_form").isNotNull()).withColumnRenamed("business_id", "id")
    joined = wanted.select("id", "icp_score").join(shown, "id")
    return first_k(joined, ["id"], order, max_pages, "page_rank")


def one_per_site(forms: DataFrame, attempts: DataFrame) -> DataFrame:
    """One form per website: hosts written to before drop out, the best-scored business claims the rest."""
    contacted = attempts.filter(F.col("outcome").isin(*DELIVERED)) \
        .select(host("action_url").alias("site")).filter(F.col("site").isNotNull()).distinct()
    fresh = forms.withColumn("site", host("action_url")).join(contacted, "site", "left_anti")
    return first_k(fresh, ["site"], [F.col("icp_score").desc_nulls_last(), F.col("id")], 1).drop("rank")
