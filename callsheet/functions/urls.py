"""URL operators. Parsing is one RFC 3986 pattern plus ``regexp_extract``; the
lenient rules (spaces, underscores, odd hosts) rule out ``parse_url``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from callsheet import dims
from callsheet.functions.regex import any_of, quote
from callsheet.functions.stages import let
from callsheet.functions.text import contains_any, strip

# scheme, //authority, path, query, fragment
URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"
HEAD = rf"^(?:{SCHEME})?(?://[^/?#]*)?"
ROOT = rf"^(?:{SCHEME})?//[^/?#]*"


def _tidy(c: Column) -> Column:
    """Drop leading control characters and blanks, and any tab or line break."""
    return F.translate(F.regexp_replace(c, r"^[\x00-\x20]+", ""), "\t\r\n", "")


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(_tidy(c), URL, 1))


def authority(c: Column) -> Column:
    return F.regexp_extract(_tidy(c), URL, 2)


def path(c: Column) -> Column:
    """Path without the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(_tidy(c), URL, 3), r";[^/]*$", "")


def params(c: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(_tidy(c), URL, 3), r";([^/]*)$", 1)


def query(c: Column) -> Column:
    return F.regexp_extract(_tidy(c), URL, 4)


def fragment(c: Column) -> Column:
    return F.regexp_extract(_tidy(c), URL, 5)


def split_url(c: Column) -> Column:
    return F.struct(
        scheme(c).alias("scheme"), authority(c).alias("authority"), path(c).alias("path"),
        params(c).alias("params"), query(c).alias("query"), fragment(c).alias("fragment"),
    )


def _lower_head(c: Column, head: str) -> Column:
    return F.concat(F.lower(F.regexp_extract(c, head, 0)), F.regexp_replace(c, head, ""))


def normalize_url(c: Column) -> Column:
    """Canonical form: lower scheme and host, no ``www.``, index file, trailing
    slash, fragment or ``fallback`` parameter; remaining parameters sorted.

    One chain of replacements over the whole string, so the expression stays
    small enough for generated code wherever it is used. What is used twice is handed on
    as a value: the sorting of parameters would run the chain again."""
    def replaced(t: Column) -> Column:
        u = _lower_head(t, HEAD)
        u = F.regexp_replace(u, r"(?s)^((?:https?|ftp):)/?([^/].*)$", "$1///$2")
        u = F.regexp_replace(u, rf"^((?:{SCHEME})?//)www\.", "$1")
        u = F.regexp_replace(
            u, rf"(?s)^((?:{SCHEME})?//[^/?]*[^?]*)/{any_of(dims.INDEX_FILES)}((?:;[^/?]*)?(?:\?.*)?)$",
            "$1/$2")
        u = F.regexp_replace(
            u, rf"(?s)^((?:{SCHEME})?//[^/?]*/[^?]*)/((?:;[^/?]*)?(?:\?.*)?)$", "$1$2")
        u = F.regexp_replace(u, rf"(?s)^((?:{SCHEME})?//[^/?]+)(\?.*)?$", "$1/$2")
        u = F.regexp_replace(u, r";(\?|$)", "$1")
        return u

    def sorted_query(v: Column) -> Column:
        kept = F.array_sort(F.filter(
            F.split(F.regexp_extract(v, r"(?s)\?(.*)$", 1), "&"),
            lambda p: F.lower(F.substring_index(p, "=", 1)) != "fallback"))
        return F.when(v.contains("?"), F.regexp_replace(
            F.concat_ws("?", F.substring_index(v, "?", 1), F.array_join(kept, "&")), r"\?$", "")
        ).otherwise(v)

    return let(F.regexp_replace(_tidy(c), r"(?s)#.*$", ""), lambda t: let(replaced(t), sorted_query))


def url_host(c: Column) -> Column:
    """Host of an already normalised URL."""
    return F.regexp_extract(c, r"^[^/?#]*//([^/?#]*)", 1)


def _with_scheme(c: Column) -> Column:
    return F.when(c.rlike(f"^{SCHEME}"), c).otherwise(F.concat(F.lit("http://"), c))


def base_domain(c: Column) -> Column:
    """``scheme://host`` without a leading ``www.``; NULL when there is no host."""
    full = F.when(c.rlike("^https?://"), c).when(
        F.substring_index(c, "/", 1).contains("."), F.concat(F.lit("http://"), c))
    root = F.nullif(F.regexp_extract(_tidy(full), "^https?://[^/?#]+", 0), F.lit(""))
    return F.regexp_replace(root, r"^(https?://)www\.", "$1")


def input_host(c: Column) -> Column:
    """Host used to spot duplicate input URLs; NULL for blank or hostless input.

    Each step is handed on as a value: every test for an empty text would run the steps before it again."""
    filled = lambda t: F.nullif(t, F.lit(""))
    host = let(let(strip(c), filled), lambda t: F.lower(authority(_with_scheme(t))))
    return let(F.regexp_replace(host, r"^www\.", ""), filled)


def percent_encode(c: Column, safe: str) -> Column:
    """Percent-encode every character outside letters, digits, ``_.-~`` and ``safe``."""
    allowed = "[A-Za-z0-9_.~\\-" + "".join(quote(ch) for ch in safe) + "]*"
    encoded = F.array_join(
        F.transform(
            F.split(c, ""),
            lambda ch: F.when(ch.rlike(f"^{allowed}$"), ch).otherwise(
                F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")),
        ), "")
    return F.when(c.rlike(f"^{allowed}$"), c).otherwise(encoded)


# URLs that need no encoding; the second form has a fragment.
PLAIN = (r"^[A-Za-z0-9+.\-]+://[^/?#\s]*[A-Za-z0-9_.~/%;=&?+\-]*$"
         rf"|^{SCHEME}//[^/?#\s]*[A-Za-z0-9_.~/%\-]*(?:\?[A-Za-z0-9_.~=&/?+%\-]*)?#[A-Za-z0-9_.~/?#%\-]*\z")


def clean_url(c: Column) -> Column:
    """Crawlable form of a typed-in URL: scheme added, blanks taken out of the
    host, the rest percent-encoded, empty path made ``/``.

    Each step is handed on as a value: as an expression it would be run again in the branch
    for plain URLs, and in the other one for every part."""
    def encoded(full: Column) -> Column:
        part = lambda i: F.regexp_extract(full, URL, i)
        last = F.regexp_extract(part(3), r";[^/]*$", 0)
        return F.concat(
            F.translate(F.regexp_extract(full, HEAD, 0), " ", ""),
            let(F.regexp_replace(part(3), r";[^/]*$", ""), lambda p: percent_encode(p, "/%")), last,
            F.lit("?"), let(part(4), lambda q: percent_encode(q, "=&/?+%")),
            F.lit("#"), let(part(5), lambda f: percent_encode(f, "/?#%")))

    head = f"^{SCHEME}"
    text = strip(F.nullif(c, F.lit("")))
    crawlable = lambda full: F.when(full.rlike(PLAIN), full).otherwise(encoded(full))
    u = let(text, lambda s: let(_tidy(_with_scheme(s)), lambda t: let(_lower_head(t, head), crawlable)))
    u = F.regexp_replace(u, r"(?s)^((?:https?|ftp):)/?([^/].*)$", "$1///$2")
    u = F.regexp_replace(u, r"(?s)^([^#]*)#$", "$1")
    u = F.regexp_replace(u, r"(?s)^([^?#]*)\?(#.*)?$", "$1$2")
    return F.regexp_replace(u, r"(?s)^([^/?#]*//[^/?#]+)([?#].*)?$", "$1/$2")


def is_http(c: Column) -> Column:
    return F.coalesce(c.rlike("^https?://"), F.lit(False))


ASCII_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def needs_tld(host: Column) -> Column:
    """Host without a top-level domain that is neither localhost nor IPv4."""
    bare = F.regexp_replace(host, r":[0-9]+$", "")
    labels = F.split(bare, "[.]")
    last = F.element_at(labels, -1)
    named = (F.size(labels) > 1) & (F.length(last) > 1) & (F.translate(F.lower(last), ASCII_LETTERS, "") == "")
    address = (F.size(labels) == 4) & F.forall(
        labels, lambda x: F.length(x).between(1, 3) & (F.translate(x, "0123456789", "") == ""))
    return (last != "") & ~named & ~address & (F.lower(bare) != "localhost")


def with_host(url: Column, host: Column) -> Column:
    """URL with its host (and port) exchanged."""
    return F.concat(F.regexp_extract(url, r"^[^/?#]*//", 0), host,
                    F.regexp_replace(url, ROOT, ""))


def _registrable(c: Column, field: int) -> Column:
    """1: domain label, 2: public suffix of a normalised URL's host."""
    host = F.regexp_replace(url_host(c), r":[0-9]+$", "")
    two = any_of(dims.TWO_LABEL_SUFFIXES)
    return F.coalesce(
        F.nullif(F.regexp_extract(host, rf"([^.]+)\.({two})$", field), F.lit("")),
        F.regexp_extract(host, r"([^.]+)\.([^.]+)$", field))


def dns_variants(c: Column) -> Column:
    """Entry URLs to try in order when the name does not resolve: as given, first
    part of a hyphenated domain, ``.de`` as ``.com``, and both."""
    return variants_of(c, _registrable(c, 1), _registrable(c, 2))


def variants_of(c: Column, label: Column, suffix: Column) -> Column:
    """The same for a known domain label and public suffix."""
    short = F.substring_index(label, "-", 1)
    hyphen = label.contains("-") & (short != "")
    german = suffix == "de"
    return F.array_distinct(F.array_compact(F.array(
        c,
        F.when(hyphen, with_host(c, F.concat_ws(".", short, suffix))),
        F.when(german, with_host(c, F.concat(label, F.lit(".com")))),
        F.when(hyphen & german, with_host(c, F.concat(short, F.lit(".com")))),
    )))


def source_path(c: Column) -> Column:
    """Path and query of a URL; ``/`` when both are empty."""
    p = F.concat(path(c), F.when(query(c) != "", F.concat(F.lit("?"), query(c))).otherwise(""))
    return F.when(p == "", F.lit("/")).otherwise(p)


def page_type(c: Column, keywords=None) -> Column:
    """contact, imprint, legal, homepage, general_content or unknown."""
    keywords = keywords or dims.PAGE_TYPE_KEYWORDS
    low = F.lower(c)
    p = path(low)
    out = F.when(c.isNull() | (c == ""), F.lit("unknown"))
    for subject in (p, low):
        for kind, words in keywords.items():
            out = out.when(contains_any(subject, words), F.lit(kind))
    return out.when(p.isin("", "/"), F.lit("homepage")).otherwise(F.lit("general_content"))


def domain_label(c: Column) -> Column:
    """Name-like label of the domain inside a report name."""
    full = (F.when(c.rlike(r"https?://[^\s]"), F.regexp_extract(c, r"https?://[^\s]+", 0))
            .when(contains_any(c, dims.LABEL_TLD_HINTS), F.concat(F.lit("http://"), c)))
    host = F.regexp_replace(url_host(_tidy(full)), r"^www\.", "")
    tld = any_of(dims.LABEL_TLDS)
    label = lambda pattern: F.nullif(F.regexp_extract(host, pattern, 1), F.lit(""))
    return F.coalesce(
        label(rf"(?s)([^.]*)\.co\.{tld}$"), label(rf"(?s)([^.]*)\.{tld}$"),
        F.substring_index(host, ".", 1))


def content_address(c: Column) -> Column:
    """Short domain prefix and 16 hex digits of the URL's SHA-256."""
    host = F.regexp_replace(authority(c), r"^www\.", "")
    prefix = F.substring(F.regexp_replace(host, r"[^\p{L}\p{N}_\-]", ""), 1, 15)
    return F.concat_ws("_", prefix, F.substring(F.sha2(c, 256), 1, 16))


def safe_name(c: Column, max_len: int = 100) -> Column:
    bare = F.regexp_replace(c, r"^https?://", "")
    return F.substring(F.regexp_replace(bare, r"[^\p{L}\p{N}_.\-]", "_"), 1, max_len)


def archive_name(c: Column, max_len: int = 100) -> Column:
    bare = F.regexp_replace(c, r"https?://", "")
    return F.substring(F.regexp_replace(bare, r"[^\p{L}\p{N}]", "_"), 1, max_len)


def with_redirect_prefix(status: Column, given_base: Column, landed_base: Column) -> Column:
    moved = given_base.isNotNull() & landed_base.isNotNull() & (given_base != landed_base)
    return F.when(moved, F.concat(F.lit("RedirectedTo["), landed_base, F.lit("]_"), status)
                  ).otherwise(status)


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` as found on page ``base``."""
    root = F.regexp_extract(base, ROOT, 0)
    page = F.regexp_extract(base, r"^[^?#]*", 0)
    folder = F.regexp_extract(base, rf"{ROOT}((?:[^?#]*/)?)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    rooted = F.when(href.startswith("/"), href).otherwise(F.concat(folder, href))
    dotted = rooted.rlike(r"^[^?#]*/\.\.?(?:[/?#]|$)")
    return (F.when(href.rlike(f"^{SCHEME}"), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^[^/]*", 0), href))
            .when(href.startswith("?"), F.concat(page, href))
            .when(href.startswith("#"), F.concat(F.regexp_extract(base, "^[^#]*", 0), href))
            .when(dotted, F.concat(
                root, _without_dots(F.regexp_extract(rooted, r"^[^?#]*", 0)),
                F.regexp_replace(rooted, r"^[^?#]*", "")))
            .otherwise(F.concat(root, rooted)))


def _without_dots(p: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of a rooted path."""
    parts = F.split(F.regexp_replace(p, "^/", ""), "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    closing = F.when(p.rlike(r"(?:^|/)\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    flat = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.concat(flat, F.when(flat == "/", F.lit("")).otherwise(closing))
