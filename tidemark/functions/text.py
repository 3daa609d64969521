"""Strings: byte limits, loose casts, URLs, lists of names, templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that carry credentials.
SENSITIVE_URL_PARAMS = ("wstoken", "token", "sesskey", "password", "newpassword", "key", "secret")


def cut_bytes(text: Column, most: int) -> Column:
    """The first bytes of a text; a character that the limit cuts through goes too."""
    raw = F.encode(text, "UTF-8")
    lead = F.conv(F.hex(F.substring(raw, most + 1, 1)), 16, 10).cast("int")  # of the first byte beyond
    whole = F.when((lead < 0x80) | (lead >= 0xC0), F.lit(most))
    for back in (0, 1, 2):  # else back to where the character starts
        byte = F.conv(F.hex(F.substring(raw, most - back, 1)), 16, 10).cast("int")
        whole = F.coalesce(whole, F.when(byte >= 0xC0, F.lit(most - back - 1)))
    kept = F.decode(F.substring(raw, F.lit(1), F.coalesce(whole, F.lit(most))), "UTF-8")
    return F.when(F.octet_length(text) > most, kept).otherwise(text)


def user_agent(text: Column) -> Column:
    """At most 1024 bytes; an empty agent is none."""
    return F.nullif(cut_bytes(text, 1024), F.lit(""))


def loose_int(text: Column) -> Column:
    """Leading digits of a text as a number, 0 if it has none."""
    return F.coalesce(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1).try_cast("long"), F.lit(0).cast("long"))


def is_empty(json: Column) -> Column:
    """Whether a JSON fragment (as get_json_object returns it) counts as empty."""
    return json.isNull() | json.isin("", "0", "false", "[]", "null", "0.0") & json.isNotNull()


def scrubbed_url(url: Column, names: tuple[str, ...] = SENSITIVE_URL_PARAMS, most: int = 2048) -> Column:
    """The URL without the named query parameters, cut to a number of bytes; null is empty."""
    url = F.coalesce(url, F.lit(""))
    anchor = F.regexp_extract(url, r"(#.*)$", 1)
    plain = F.regexp_replace(url, r"#.*$", "")
    base = F.substring_index(plain, "?", 1)
    query = F.when(F.instr(plain, "?") > 0, F.substring(plain, F.instr(plain, "?") + 1, F.lit(2147483647))).otherwise(F.lit(""))
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*names)), "&")
    return cut_bytes(F.concat(base, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")), anchor), most)


def column_names(raw: Column) -> Column:
    """Names in a list that is divided by white space or commas."""
    return F.filter(F.split(raw, r"[\s,]+"), lambda x: x != "")


def name_sample(names: Column, most: int = 3) -> Column:
    """The first few names and how many more there are."""
    rest = F.size(names) - most
    return F.concat(F.array_join(F.slice(names, 1, most), ", "), F.when(rest > 0, F.concat(F.lit(" (+"), rest.cast("string"), F.lit(" more)"))).otherwise(F.lit("")))


def plain_label(html: Column) -> Column:
    """A label without tags and with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"<[^>]*>", ""), r"\s+", " "))


def display_name(resolved: Column, name: Column, shortname: Column) -> Column:
    """The first of a role's names that isn't blank."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(blank(resolved), blank(name), shortname, F.lit(""))


def rendered_detail(stored: Column, templates: dict[str, str]) -> Column:
    """A stored {"key", "params"} detail through its template; what has no template, or is no detail, stays as it is."""
    stored = F.trim(stored)
    key = F.get_json_object(stored, "$.key")
    out = F.lit(None).cast("string")
    for name, template in templates.items():
        text = F.lit(template)
        for field in _fields(template):
            value = F.get_json_object(stored, f"$.params.{field}")
            text = F.when(value.isNull(), F.replace(text, F.lit("{" + field + "}"), F.lit("?"))).otherwise(F.replace(text, F.lit("{" + field + "}"), value))
        out = F.when(key == name, text).otherwise(out)
    return F.when(F.startswith(stored, F.lit("{")), F.coalesce(out, stored)).otherwise(stored)


def _fields(template: str) -> list[str]:
    import re

    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", template)))
