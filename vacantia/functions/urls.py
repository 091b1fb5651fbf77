"""URL helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia import fixed
from vacantia.functions.text import first_match


def path_id(link: Column) -> Column:
    """Posting id in the path of a careers link."""
    return first_match(link, fixed.FACEBOOK_LINK_ID)


def request_id(link: Column) -> Column:
    """Posting id in the ``req`` parameter of an application link."""
    return first_match(link, fixed.FACEBOOK_REQUEST_ID)


def result_id(link: Column) -> Column:
    """Posting id in a search-result link; the last ``?src`` ends it."""
    return first_match(link, fixed.DICE_RESULT_ID)


def detail_url(link: Column) -> Column:
    return F.replace(link, F.lit(fixed.DICE_RESULT_PREFIX), F.lit(fixed.DICE_DETAIL_PREFIX))


def posting_url(job_id: Column) -> Column:
    return F.concat(F.lit(fixed.APPLE_POSTING_URL), job_id)


def without_dots(path: Column) -> Column:
    """A path from the root without dot segments: ``.`` goes, ``..`` takes the segment before it along.

    Written-out dots (``%2e``) count too, and a path that ends in such a segment ends in a slash.
    """
    parts = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    dot = lambda s: F.lower(F.regexp_replace(s, "(?i)%2e", ".")) == "."
    up = lambda s: F.lower(F.regexp_replace(s, "(?i)%2e", ".")) == ".."

    def step(kept, s):
        shorter = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(up(s), shorter).when(dot(s), kept).otherwise(F.concat(kept, F.array(s)))

    last = F.element_at(parts, -1)
    end = F.when(dot(last) | up(last), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    plain = F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))
    return F.when(path.rlike(r"(?i)/(\.|%2e)"), plain).otherwise(path)


def resolve(base: Column, ref: Column) -> Column:
    """Resolve a reference against a page address; an empty reference is the page itself.

    Dot segments of a path are followed, not those of a query, a fragment or a whole address.
    """
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*(/(?:.*/)?)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    rest = F.substring(ref, F.length(path) + 1, F.length(ref))
    return (
        F.when(ref.isNull() | (ref == ""), base)
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, ref))
        .when(ref.startswith("/"), F.concat(origin, without_dots(path), rest))
        .when(ref.startswith("?"), F.concat(page, ref))
        .when(ref.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), ref))
        .otherwise(F.concat(origin, without_dots(F.concat(folder, path)), rest))
    )
