"""Functions on text: spaces, identity of stories, HTTP outcomes, retry times, strata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(text: Column) -> Column:
    """Single spaces between words."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def valid_day(text: Column) -> Column:
    """Whether text is a day of the calendar as YYYY-MM-DD."""
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"(?U)\W+"), lambda w: w != "")


def headline(title: Column) -> Column:
    """A title without the site's name after ` | ` or ` - `."""
    return F.get(F.split(F.get(F.split(title, r" \| "), F.lit(0)), " - "), F.lit(0))


def same_story(title: Column, text: Column, other_title: Column, other_text: Column) -> Column:
    """`headline` where the titles' words agree by Dice 0.8 (five words at least),
    `opening_text` where the first twelve words of a paragraph open the other text
    somewhere, null else."""
    a, b = F.array_distinct(tokens(headline(title))), F.array_distinct(tokens(headline(other_title)))
    common = F.size(F.array_intersect(a, b))
    alike = (F.least(F.size(a), F.size(b)) >= 5) & (2 * common >= 0.8 * (F.size(a) + F.size(b)))
    full = F.array_join(tokens(other_text), " ")
    opens = F.exists(F.split(text, "\n\n"), lambda p: (F.size(tokens(p)) >= 12) & full.contains(F.array_join(F.slice(tokens(p), 1, 12), " ")))
    return F.when(alike, "headline").when(opens, "opening_text")


#: Titles of pages that are no article.
CHALLENGES = ("just a moment", "access denied", "attention required", "verify you are human", "captcha")
MISSING = ("page not found", "404 not found", "page cannot be found")


def _any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def http_outcome(code: Column, large: Column, content_type: Column, title: Column, requested: Column, final: Column) -> Column:
    """What a response means for an article; the order of the rules matters."""
    from presswork.functions.urls import part

    low = F.lower(F.coalesce(title, F.lit("")))
    bare = lambda u: F.coalesce(part(u, "PATH"), F.lit("")).isin("", "/")
    return (
        F.when(code == 429, "rate_limited").when(large, "needs_inspection").when(code.isin(401, 403), "blocked").when(code.isin(404, 410), "unavailable")
        .when(code >= 500, "temporary_error").when(code != 200, "needs_inspection").when(~F.lower(F.coalesce(content_type, F.lit(""))).contains("html"), "needs_inspection")
        .when(_any(low, CHALLENGES), "blocked").when(_any(low, MISSING), "needs_inspection").when(bare(final) & ~bare(requested), "needs_inspection").otherwise("retrieved")
    )


def retry_after(value: Column, attempt: Column, now: Column) -> Column:
    """Seconds to wait: the header's number or date, five at least; without one
    10 * 2 ** (attempt - 1), 120 at most."""
    when = F.try_to_timestamp(F.substring(value, 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))
    least = lambda x: F.when(x.isNotNull(), F.greatest(F.lit(5.0), x))  # noqa: E731  greatest() skips nulls
    by_date = least((F.unix_micros(when) - F.unix_micros(now)) / 1e6)
    return F.coalesce(least(value.try_cast("double")), by_date, F.least(F.lit(120.0), 10 * F.pow(F.lit(2.0), attempt - 1)))


def stratum(i: int, n: int) -> str:
    """The middle of the i-th of n equal ranges of SHA-256 digests."""
    return f"{((2 * i + 1) * 2**256) // (2 * n):064x}"


def cost(seconds: Column, cpus: float, gib: float) -> Column:
    return seconds * (cpus * 1.8e-5 + gib * 2e-6)


def tail_link(attempts: Column) -> Column:
    """The first two distinct URLs in order."""
    return F.slice(F.array_distinct(attempts), 1, 2)
