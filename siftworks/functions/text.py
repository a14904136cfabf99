"""String, URL, hash and page functions as Column expressions."""

from __future__ import annotations

import html
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that a slug keeps: letters and digits of any script, underscore and hyphen.
SLUG_DROPS = r"[^\p{L}\p{N}_\-]+"
HTTP = "^https?://"


def strip(c: Column) -> Column:
    """Without white space at either end (``trim`` takes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def truthy(c: Column) -> Column:
    """The string, or null where it is empty."""
    return F.nullif(c, F.lit(""))


def slug(c: Column) -> Column:
    """Lower-cased name with runs of other characters as one hyphen; the start of the sha1 where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), SLUG_DROPS, "-"), "-{2,}", "-")
    s = F.regexp_replace(s, "^[-_]+|[-_]+$", "")
    return F.when(s == "", F.substring(F.sha1(c), 1, 12)).otherwise(s)


def url_key(c: Column) -> Column:
    return F.md5(c)


def content_key(c: Column) -> Column:
    return F.sha1(c)


def is_http(c: Column) -> Column:
    return F.coalesce(c.rlike(HTTP), F.lit(False))


def first_valid_url(fields: Sequence[Column], replacements: Column | None = None) -> Column:
    """The first http(s) URL among ``fields``, then among each replacement's ObjURL and FromURL."""
    urls = F.array(*fields)
    if replacements is not None:
        more = F.flatten(F.transform(replacements, lambda r: F.array(r["ObjURL"], r["FromURL"])))
        urls = F.concat(urls, F.coalesce(more, F.array().cast("array<string>")))
    return F.get(F.filter(urls, is_http), 0)


def first_truthy_url(fields: Sequence[Column]) -> Column:
    """The first non-empty field, if that is an http(s) URL; else null even where a later one is."""
    first = F.coalesce(*(truthy(f) for f in fields))
    return F.when(is_http(first), first)


def absolute(c: Column) -> Column:
    """``//host`` as ``https://host``."""
    return F.when(c.startswith("//"), F.concat(F.lit("https:"), c)).otherwise(c)


def query_part(url: Column, key: str) -> Column:
    """A decoded query parameter; null where the URL or the encoding is malformed."""
    return F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(key)))


def query_map(url: Column) -> Column:
    """All query parameters, decoded, blanks kept, the last of equal keys."""
    pairs = F.transform(F.split(F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit("")), "&"), lambda p: F.struct(F.try_url_decode(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), F.coalesce(F.try_url_decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)), F.lit("")).alias("v")))
    pairs = F.filter(pairs, lambda p: p["k"].isNotNull() & (p["k"] != ""))
    last = lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))), lambda q: q["k"] == p["k"])
    return F.map_from_entries(F.filter(pairs, last))


#: The five entities that need no table; the ampersand comes last.
CORE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def unescape_core(c: Column) -> Column:
    for entity, char in CORE_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


@F.pandas_udf(T.StringType())
def unescape_all(s: pd.Series) -> pd.Series:
    """All named and numeric entities: the table has thousands, so this is not an expression."""
    return s.map(html.unescape, na_action="ignore")


#: Escaped UTF-16 code units: single ones, or a pair of surrogates; a lone surrogate is none.
_UNIT = r"[0-9a-fA-F]"
UTF16_ESCAPES = rf"(?:\\u(?![dD][89a-fA-F]){_UNIT}{{4}}|\\u[dD][89abAB]{_UNIT}{{2}}\\u[dD][c-fC-F]{_UNIT}{{2}})+"


def unescape_backslashes(c: Column) -> Column:
    """Escapes of UTF-16 code units and of the slash, as scripts write them, decoded; others stay."""
    units = F.transform(F.regexp_extract_all(c, F.lit(UTF16_ESCAPES), F.lit(0)), lambda r: F.decode(F.unhex(F.replace(r, F.lit(chr(92) + "u"), F.lit(""))), "UTF-16BE"))
    rest = F.split(c, UTF16_ESCAPES, -1)
    joined = F.concat(F.get(rest, 0), F.array_join(F.zip_with(units, F.slice(rest, F.lit(2), F.size(units)), lambda u, r: F.concat(u, r)), ""))
    return F.replace(F.when(c.contains(chr(92) + "u"), joined).otherwise(c), F.lit(chr(92) + "/"), F.lit("/"))


def entry_image(obj_url: Column, thumb_url: Column, middle_url: Column) -> Column:
    """Image URL of a similar-search entry: from objUrl's query, then thumbUrl or middleUrl; must start with http."""
    inner = [query_part(obj_url, k) for k in ("image", "imgurl", "imgUrl")]
    tries = F.transform(F.array(F.coalesce(*(truthy(x) for x in inner)), F.coalesce(truthy(thumb_url), truthy(middle_url))), lambda u: absolute(unescape_core(strip(u))))
    return F.get(F.filter(tries, lambda u: F.coalesce(u.startswith("http"), F.lit(False))), 0)


def first_match(c: Column, patterns: Sequence[str], group: int = 1) -> Column:
    """The group of the first pattern that matches."""
    return F.coalesce(*(truthy(F.regexp_extract(c, p, group)) for p in patterns))


#: Patterns of a search page; the image hosts are a parameter of the functions below.
TOKEN_PATTERNS = (r'(?i)"token"\s*:\s*"([0-9a-z]{16,64})"', r"(?i)window\.__INITIAL_STATE__[^{}]+token[\"']\s*:\s*[\"']([0-9a-z]{16,64})", r"(?i)token\s*=\s*[\"']([0-9a-z]{16,64})[\"']")
STATE_PATTERN = r'__PRELOADED_STATE__\s*=\s*"([^"]+)"'
CAROUSEL_PATTERN = r"carousel\s*[:=]\s*[\"']?(\d{3,6})[\"']?"
QUERY_IMAGE_PATTERNS = (r'"queryImageUrl"\s*:\s*"([^"]+)"', r'queryImageUrl\s*=\s*"([^"]+)"', r'data-imgurl="([^"]+)"', r'"imgUrl"\s*:\s*"([^"]+)"')


def query_image(page: Column) -> Column:
    """The query image's URL in a result page."""
    return absolute(first_match(page, QUERY_IMAGE_PATTERNS))


def state_token(blob: Column) -> Column:
    """The token in a base64 blob of JSON state; null where anything is malformed."""
    state = F.try_parse_json(F.decode(F.try_to_binary(blob, F.lit("base64")), "UTF-8"))
    return F.coalesce(*(truthy(F.try_variant_get(state, p, "string")) for p in ("$.similarResult.token", "$.similarList.token", "$.token")))


def page_context(page: Column, image_hosts: str = r"[a-z]+\d+\.[a-z.]+", main_url: Column | None = None) -> Column:
    """image, token, carousel, ajax parameters (and sign of the page's own URL) of a result page, each null if absent."""
    text = unescape_core(page)
    image = first_match(text, (rf'(?i)"queryImageUrl"\s*:\s*"(https?://{image_hosts}/[^"]+)"', rf'(?i)"image"\s*:\s*"(https?://{image_hosts}/[^"]+)"', rf"(?i)(https?://{image_hosts}/[^\s\"'<>]+)"))
    image = strip(F.get(F.split(strip(unescape_core(image)), r"\);|[\"'<>]"), 0))
    token = F.coalesce(first_match(text, TOKEN_PATTERNS), state_token(truthy(F.regexp_extract(text, STATE_PATTERN, 1))))
    ajax = unescape_backslashes(F.regexp_extract(text, r"(https?:[^\s\"'<>]*ajax[^\s\"'<>]*)", 1))
    sign = query_part(main_url, "sign") if main_url is not None else F.lit(None).cast("string")
    return F.struct(image.alias("image"), token.alias("token"), truthy(F.regexp_extract(text, CAROUSEL_PATTERN, 1)).alias("carousel"), query_map(ajax).alias("ajax_params"), sign.alias("sign"))


def image_urls(page: Column, pattern: str = r"(https?://[^\s\"'<>]+?\.(?:jpg|jpeg|png|webp|bmp))") -> Column:
    """Distinct image URLs of a page in sorted order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(unescape_core(page), F.lit(pattern), F.lit(1))))


def links(page: Column, pattern: str = r'href="([^"]*)"') -> Column:
    """Distinct link targets of a page in sorted order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(page, F.lit(pattern), F.lit(1))))


def resolve(target: Column, base: Column) -> Column:
    """A link target against the page's URL: absolute ones as they are, ``//x`` and ``/x`` completed, others below the page."""
    scheme, host = F.regexp_extract(base, "^([a-z]+):", 1), F.regexp_extract(base, "^([a-z]+://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "^([a-z]+://[^/?#]*(?:/[^/?#]*)*/)[^/?#]*", 1)
    return F.when(target.rlike("^[a-z]+:"), target).when(target.startswith("//"), F.concat(scheme, F.lit(":"), target)).when(target.startswith("/"), F.concat(host, target)).otherwise(F.concat(F.when(folder == "", F.concat(host, F.lit("/"))).otherwise(folder), target))


def build_url(base: str, params: Sequence[tuple[str, Column]], spaces_as_percent: bool = False) -> Column:
    """``base?k=v&...`` with form encoding, or with %20 for spaces."""
    enc = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")) if spaces_as_percent else F.url_encode(c)
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *(F.concat(F.lit(f"{k}="), enc(c)) for k, c in params)))


def hex_offset(offset: Column) -> Column:
    return F.lower(F.hex(offset))


def relative_path(path: Column, root: str) -> Column:
    """The path below ``root``; as it is where it is not below."""
    top = root.rstrip("/") + "/"
    return F.when(path.startswith(top), F.substring(path, F.lit(len(top) + 1), F.length(path))).otherwise(path)


def identifier(candidates: Sequence[Column], ordinal: Column) -> Column:
    """The first non-empty candidate, else ``row-%05d``."""
    return F.coalesce(*(truthy(c) for c in candidates), F.format_string("row-%05d", ordinal))


#: MIME types by file name ending.
MIME = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "webp": "image/webp", "bmp": "image/bmp", "gif": "image/gif"}


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))


def mime(path: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in MIME.items() for x in kv))
    return F.coalesce(F.element_at(known, extension(path)), F.lit("application/octet-stream"))


def data_url(content: Column, path: Column) -> Column:
    """Bytes as a data URL, without the line breaks that ``base64`` puts in."""
    return F.concat(F.lit("data:"), mime(path), F.lit(";base64,"), F.regexp_replace(F.base64(content), r"[\r\n]", ""))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"\.[^.]+$", "")


def choose_sha1(known: Column, path: Column, content: Column | None = None, use_stem: bool = True) -> Column:
    """The recorded sha1, else a file stem of 40 hex digits in lower case, else the content's own."""
    own = F.lower(stem(path))
    tries = [known] + [F.when(own.rlike("^[0-9a-f]{40}$"), own)] * use_stem + ([content_key(content)] if content is not None else [])
    return F.coalesce(*tries)


def page_size(c: Column, default: int = 30, low: int = 30, high: int = 60) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(c.try_cast("int"), F.lit(default))))


#: Fixed values of an obfuscated URL notation: three tokens, then one character for another.
OBFUSCATED_TOKENS = (("_z2C$q", ":"), ("_z&e3B", "."), ("AzdH3F", "/"))
OBFUSCATED_FROM = "wkv1ju2it3hs4g5rq6fp7eo8dn9cm0bla"
OBFUSCATED_TO = "abcdefghijklmnopqrstuvwxyz0123456"


def deobfuscate(url: Column) -> Column:
    for token, char in OBFUSCATED_TOKENS:
        url = F.replace(url, F.lit(token), F.lit(char))
    return F.translate(url, OBFUSCATED_FROM, OBFUSCATED_TO)


def upload_context(payload: Column, page_of_sign: str = "{sign}") -> Column:
    """sign and page_url of an upload's JSON answer: the first non-empty of three names, else the page URL's own; the page is rebuilt from the sign where it is missing."""
    raw = F.try_parse_json(payload)
    get = lambda k: truthy(F.try_variant_get(raw, f"$.data.{k}", "string"))
    sign = F.coalesce(get("sign"), get("querySign"), get("uqid"), truthy(query_part(get("url"), "sign")))
    before, after = page_of_sign.split("{sign}")
    return F.struct(sign.alias("sign"), F.coalesce(get("url"), F.concat(F.lit(before), sign, F.lit(after))).alias("page_url"))


def log_id() -> Column:
    """Milliseconds and six random digits; differs from run to run."""
    return F.concat(F.unix_millis(F.current_timestamp()).cast("string"), F.format_string("%06d", F.floor(F.rand() * 1_000_000).cast("int")))
