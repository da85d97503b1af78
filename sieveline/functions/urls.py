"""Column expressions over URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track (fixed values).
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)"
IMAGE_ENDS = (".jpg", ".jpeg", ".png", ".gif", ".webp")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def normalize(url: Column) -> Column:
    """Lower-case scheme and host, without fragment, tracking parameters and a final slash."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, rf"(?<=[?&]){TRACKING}=[^&]*(&|$)", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "[?&]+$", ""), "/+$", "")
    head = F.regexp_extract(bare, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    return F.concat(F.lower(head), F.substr(bare, F.length(head) + 1))


def flags(url: Column) -> dict[str, Column]:
    """What a link leads to, by its form."""
    path = F.lower(F.regexp_replace(url, r"[?#].*$", ""))
    image = F.lit(False)
    for end in IMAGE_ENDS:
        image = image | path.endswith(end)
    return {
        "is_image": image,
        "is_gallery": url.contains("/gallery/"),
        "is_video": url.rlike(r"://(www\.)?(youtube\.com|youtu\.be|vimeo\.com|v\.redd\.it)/"),
        "is_arxiv": url.rlike(r"^https?://arxiv\.org/"),
        "has_tracking": url.rlike(rf"[?&]{TRACKING}="),
    }


def absolute(url: Column, site: str) -> Column:
    """Site-relative links made absolute, share marks dropped."""
    return F.when(url.startswith("/r/"), F.concat(F.lit(site), url)).otherwise(F.replace(url, F.lit("&feature=share"), F.lit("")))
