"""Catalog / listing payloads already landed as text: HTML directory listings, catalog item
JSON, paged collection responses, URL lists. (Fetching them over HTTP is out of scope.)"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpina.fixed_values import ASSET_FIELDS, TILE_NAME_PATTERN
from alpina.operators.dedupe import distinct_first


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resolve_url(href, base) -> Column:
    """Resolve a link against its page URL: absolute, scheme-relative, root-relative,
    query/fragment-only, or relative to the base's folder; dot segments are resolved."""
    h, b = _col(href), _col(base)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(b, r"#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    folder = F.regexp_extract(no_query, r"^(.*/)", 1)
    folder = F.when(F.length(folder) <= F.length(origin), F.concat(origin, F.lit("/"))).otherwise(folder)
    return (F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("?"), F.concat(no_query, h))
            .when(h.startswith("#"), F.concat(no_frag, h))
            .when(h.startswith("/"), without_dots(F.concat(origin, h), origin))
            .otherwise(without_dots(F.concat(folder, h), origin)))


def without_dots(url: Column, origin: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of the path (never above the origin); query and fragment stay."""
    path = F.regexp_extract(F.substr(url, F.length(origin) + 1), r"^[^?#]*", 0)
    rest = F.substr(url, F.length(origin) + F.length(path) + 1)
    steps = F.split(path, "/", -1)
    walked = F.aggregate(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), F.array().cast("array<string>"),
                         lambda out, s: F.when(s == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))))
                         .when(s == ".", out).otherwise(F.concat(out, F.array(s))))
    folder = F.when(F.element_at(steps, -1).isin(".", "..") & (F.size(walked) > 0), F.lit("/")).otherwise("")
    clean = F.concat(origin, F.lit("/"), F.array_join(walked, "/"), folder, rest)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), clean).otherwise(url)


def extract_links(df: DataFrame, html_col: str, base_col: str, ext: str | None = None,
                  key_cols: tuple[str, ...] = ()) -> DataFrame:
    """HTML listing → distinct absolute links that are **direct children** of the base folder,
    optionally ending in ``.<ext>`` (case-insensitive), sorted per listing.

    Every link of a listing comes from its one HTML row, so extraction, resolution, the
    direct-child test, de-duplication and sorting all run inside the row (array functions):
    no shuffle. One output row per (listing keys, link), exploded in sorted order."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(r'(?i)href="([^"]+)"'), F.lit(1))
    if ext:
        suffix = "." + ext.lower()
        hrefs = F.filter(hrefs, lambda h: F.lower(h).endswith(suffix))
    base = F.col(base_col)
    links = F.transform(hrefs, lambda h: resolve_url(h, base))
    children = F.filter(links, lambda u: F.regexp_extract(u, r"^(.*/)[^/]*$", 1) == base)
    ordered = F.array_sort(F.array_distinct(children))
    return df.select(*key_cols, F.explode(ordered).alias("link"))


ASSET_SCHEMA = ("struct<assets: map<string, struct<"
                + ", ".join(f"`{f}`: string" for f in ASSET_FIELDS) + ">>>")
PAGE_SCHEMA = "struct<features: array<struct<id: string>>, links: array<struct<rel: string, href: string>>>"


def catalog_assets(df: DataFrame, json_col: str, folder_col: str, suffix: str | None = None) -> DataFrame:
    """Catalog item JSON → one row per asset (folder, key, href, checksum, updated).

    ``suffix`` keeps only asset keys ending with it (collection-level metadata uses ``.csv``)."""
    parsed = df.select(F.col(folder_col).alias("folder"),
                       F.explode(F.from_json(F.col(json_col), ASSET_SCHEMA)["assets"]).alias("key", "a"))
    if suffix:
        parsed = parsed.where(F.col("key").endswith(suffix))
    return parsed.select("folder", "key", F.col("a.href").alias("href"),
                         F.col("a").getField("file:checksum").alias("checksum"),
                         F.col("a.updated").alias("updated"))


def item_ids(pages: DataFrame, json_col: str) -> DataFrame:
    """Paged collection responses → sorted item ids."""
    p = F.from_json(F.col(json_col), PAGE_SCHEMA)
    return (pages.select(F.explode(p["features"]).alias("f"))
            .select(F.col("f.id").alias("item_id")).where(F.col("item_id").isNotNull())
            .orderBy("item_id"))


def next_link(json_col: str) -> Column:
    """The ``rel == next`` link of a page (NULL on the last page)."""
    p = F.from_json(F.col(json_col), PAGE_SCHEMA)
    return F.get(F.filter(p["links"], lambda l: l["rel"] == "next"), 0)["href"]  # NULL past the end (ANSI)


def parse_url_list(df: DataFrame, line_col: str, ordinal_col: str,
                   name_pattern: str = TILE_NAME_PATTERN) -> DataFrame:
    """URL list lines → (ordinal, url, name): whitespace and surrounding quotes stripped, only
    ``http…`` lines, names not matching ``name_pattern`` dropped, first occurrence per name."""
    url = F.regexp_replace(F.trim(F.col(line_col)), r'^"+|"+$', "")
    rows = df.select(F.col(ordinal_col).alias("ordinal"), url.alias("url"))
    rows = rows.where(F.col("url").startswith("http"))
    rows = rows.withColumn("name", F.regexp_extract("url", r"([^/]*)$", 1))
    rows = rows.where(F.col("name").rlike(name_pattern))
    return distinct_first(rows, ["name"], "ordinal")
