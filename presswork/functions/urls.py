"""Functions on URLs and hosts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: how an archive's replay URL embeds the original.
REPLAY = r"^/web/[0-9]{1,14}(?:(?:id|if|im|js|cs|oe|mp)_)?/(https?://.+)$"


def part(url: Column, name: str) -> Column:
    """A part of a URL; null where there is none or the URL can't be read."""
    return F.try_parse_url(url, F.lit(name))


def host(url: Column) -> Column:
    return F.lower(part(url, "HOST"))


def is_public(url: Column) -> Column:
    """http(s), a host, no user, and no port but 80 and 443. Addresses are not resolved."""
    port = F.regexp_extract(part(url, "AUTHORITY"), r":([0-9]*)$", 1)
    good = part(url, "PROTOCOL").isin("http", "https") & part(url, "HOST").isNotNull() & part(url, "USERINFO").isNull() & port.isin("", "80", "443")
    return F.coalesce(good, F.lit(False))


def publisher_host(url: Column) -> Column:
    """The host that published a URL: that of the embedded one for an archive's replay."""
    web = part(url, "PROTOCOL").isin("http", "https")
    original = F.regexp_extract(F.coalesce(part(url, "PATH"), F.lit("")), REPLAY, 1)
    return F.when(web & (host(url) == "web.archive.org"), F.when(original != "", host(original))).when(web, host(url))


def normal_host(name: Column) -> Column:
    """Lower case without a last dot; null with spaces, slashes or nothing left."""
    text = F.rtrim(F.lower(F.trim(name)), F.lit("."))
    return F.when(~text.rlike(r"[\s/]") & (text != ""), text)


def label(url: Column, outlet: Column) -> Column:
    """A name for a story from the last part of its path, or a plain one."""
    last = F.element_at(F.split(F.rtrim(F.coalesce(part(url, "PATH"), F.lit("")), F.lit("/")), "/"), -1)
    text = F.coalesce(F.try_url_decode(last), last)
    # fixed values: endings of files and the words of a plain name
    text = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?i)\.(html?|aspx?|php)$", ""), r"[-_]+", " "))
    return F.when(F.length(text) > 12, text).otherwise(F.concat(F.lit("Open article on "), F.coalesce(outlet, F.lit("this site"))))


def bare_homepage(requested: Column, final: Column) -> Column:
    """Whether a request for a page ended on a bare homepage."""
    bare = lambda u: F.coalesce(part(u, "PATH"), F.lit("")).isin("", "/")
    return ~bare(requested) & bare(final) & part(final, "QUERY").isNull()


def evidence_path(uri: Column, bucket: str, run_id: Column, article_id: Column) -> Column:
    """Whether a URI names evidence of the run's article in the bucket."""
    start = F.concat(F.lit(f"gs://{bucket}/runs/"), run_id, F.lit("/results/"), article_id, F.lit("/"))
    return F.coalesce(F.startswith(uri, start) & F.substr(uri, F.length(start) + 1).rlike(r"^[A-Za-z0-9_.-]+\.json(\.gz)?$"), F.lit(False))


def joined(base: Column, link: Column) -> Column:
    """A link as a page at base means it: absolute, of the same scheme, from the root, a query
    or fragment alone, or beside the page; dot segments are left as they are."""
    scheme, site = part(base, "PROTOCOL"), part(base, "AUTHORITY")
    root = F.concat(scheme, F.lit("://"), site)
    path = F.coalesce(part(base, "PATH"), F.lit(""))
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", "")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike(r"^[?#]"), F.concat(root, path, link)).when(link == "", base).otherwise(F.concat(root, folder, link))
    )


def other_page(url: Column, link: Column) -> Column:
    """The page on the same host that a link at url names, if its path has more than five
    characters and it is another URL; null else (X20)."""
    full = joined(url, link)
    good = (host(full) == host(url)) & (F.length(part(full, "PATH")) > 5) & (full != url)
    return F.when(good, full)
