"""File-format behaviour: header drift, charsets, empty fields, JSON forms, corrupt files,
hidden folders, listings."""

import pytest
from pyspark.sql import functions as F

from alpina.operators.quality import split_corrupt_files
from alpina.session import local_path
from alpina.sources.delimited import read_charset_csv, read_delimited, read_delimited_union
from alpina.sources.files import list_files, with_lineage
from alpina.sources.json_text import read_json_strings
from alpina.sources.web import extract_links, parse_url_list


def _write(path, name, text, encoding="utf-8"):
    import os
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/{name}", "wb") as f:
        f.write(text.encode(encoding))


def test_union_of_differing_headers_binds_by_name(spark, scratch):
    root = scratch("hdr")
    _write(f"{root}/a", "ogd-smn_aaa_h_recent.csv", "station_abbr;reference_timestamp;p1\nAAA;01.01.2025 00:00;1.5\n")
    _write(f"{root}/b", "ogd-smn_bbb_h_recent.csv", "station_abbr;reference_timestamp;p2;p1\nBBB;01.01.2025 00:00;7;2.5\n")
    df = read_delimited_union(spark, [f"{root}/a", f"{root}/b"], ";", "station_abbr")
    rows = {r["station_abbr"]: r.asDict() for r in df.collect()}
    assert rows["AAA"]["p1"] == "1.5" and rows["AAA"]["p2"] is None
    assert rows["BBB"]["p1"] == "2.5" and rows["BBB"]["p2"] == "7"
    assert all(isinstance(v, (str, type(None))) for r in rows.values() for v in r.values())


def test_windows_1252_round_trip(spark, scratch):
    root = scratch("cp")
    _write(root, "ogd-smn_meta_stations.csv", "code;name\nZRH;Zürich €uro\nGVE;Genève\n", encoding="windows-1252")
    df = read_charset_csv(spark, root, ";", "windows-1252")
    got = {r["code"]: r["name"] for r in df.collect()}
    assert got == {"ZRH": "Zürich €uro", "GVE": "Genève"}


def test_keep_empty_strings(spark, scratch):
    root = scratch("empty")
    _write(root, "x.csv", 'a,b,c\n1,,"x"\n2,"",\n')
    kept = {r["a"]: (r["b"], r["c"]) for r in read_delimited(spark, root, ",", keep_empty=True).collect()}
    assert kept == {"1": ("", "x"), "2": ("", "")}
    nulls = {r["a"]: r["b"] for r in read_delimited(spark, root, ",").collect()}
    assert nulls["1"] is None


@pytest.mark.parametrize("layout", ["ndjson", "array"])
def test_json_strings_keep_nested_text(spark, scratch, layout):
    root = scratch("json")
    recs = ['{"id": 1, "ok": true, "v": 1.50, "o": {"x": 1}}', '{"id": 2, "l": [1, 2], "v": null}']
    text = "\n".join(recs) if layout == "ndjson" else "[" + ",\n".join(recs) + "]"
    _write(root, "live.json", text)
    df = read_json_strings(spark, root)
    rows = {r["id"]: r.asDict() for r in df.collect()}
    assert set(df.columns) == {"id", "ok", "v", "o", "l"}
    assert rows["1"]["ok"] == "true" and rows["1"]["v"] == "1.50"
    assert rows["1"]["o"].replace(" ", "") == '{"x":1}'
    assert rows["2"]["l"].replace(" ", "") == "[1,2]" and rows["2"]["v"] is None and rows["2"]["o"] is None


def test_corrupt_file_is_rejected_whole(spark, scratch):
    root = scratch("corrupt")
    _write(root, "good.json", '{"a": "1"}\n{"a": "2"}\n')
    _write(root, "bad.json", '{"a": "3"}\n{"a": \n')
    parsed = with_lineage(read_json_strings(spark, root, multi_line=False, corrupt_col="_corrupt_record"))
    good, errors = split_corrupt_files(parsed, scratch("stage"))
    assert sorted(r["a"] for r in good.collect()) == ["1", "2"]
    errs = errors.collect()
    assert len(errs) == 1 and errs[0]["file"].endswith("bad.json") and errs[0]["n_corrupt"] == 1


def test_hidden_meta_folder_needs_explicit_path(spark, scratch):
    root = scratch("meta")
    _write(f"{root}/_meta", "ogd-smn_meta_parameters.csv", "k;v\na;1\n")
    _write(f"{root}/chz", "ogd-smn_chz_d_recent.csv", "k;v\nb;2\n")
    listed = [r["name"] for r in list_files(spark, root, "*.csv").collect()]
    assert listed == ["ogd-smn_chz_d_recent.csv"]
    assert read_delimited(spark, f"{root}/_meta", ";").count() == 1


def test_list_files_glob_on_base_name(spark, scratch):
    root = scratch("glob")
    for n in ("abc1.csv", "abc_pluvio.csv", "x.txt"):
        _write(f"{root}/by_station", n, "a\n1\n")
    names = sorted(r["name"] for r in list_files(spark, root, "???[0-9].csv").collect())
    assert names == ["abc1.csv"]
    names = sorted(r["name"] for r in list_files(spark, root, "*_pluvio.csv").collect())
    assert names == ["abc_pluvio.csv"]


def test_extract_links_direct_children_with_extension(spark):
    html = ('<a href="a.csv">a</a> <A HREF="B.CSV">b</A> <a href="sub/c.csv">c</a> '
            '<a href="/archive/data/d.csv">d</a> <a href="https://other/x.csv">x</a> <a href="e.txt">e</a>'
            '<a href="a.csv">dup</a>')
    df = spark.createDataFrame([(html, "https://m.example/archive/data/")], "html string, base string")
    got = [r["link"] for r in extract_links(df, "html", "base", ext="csv").collect()]
    assert got == ["https://m.example/archive/data/B.CSV", "https://m.example/archive/data/a.csv",
                   "https://m.example/archive/data/d.csv"]


def test_parse_url_list_first_occurrence(spark):
    lines = [(0, '"https://x/swissalti3d_2019_2501-1120_2_2056_5728.tif"'), (1, "# comment"),
             (2, "https://y/swissalti3d_2019_2501-1120_2_2056_5728.tif"), (3, "https://z/not-a-tile.tif"),
             (4, "  https://x/swissalti3d_2021_2600-1200_0.5_2056_5728.tif  ")]
    df = spark.createDataFrame(lines, "n long, line string")
    got = sorted((r["ordinal"], r["url"]) for r in parse_url_list(df, "line", "n").collect())
    assert got == [(0, "https://x/swissalti3d_2019_2501-1120_2_2056_5728.tif"),
                   (4, "https://x/swissalti3d_2021_2600-1200_0.5_2056_5728.tif")]


def test_lineage_columns(spark, scratch):
    root = scratch("lin")
    _write(root, "f1.csv", "a\n1\n2\n")
    df = with_lineage(read_delimited(spark, root, ","))
    r = df.select("_source_file", "_source_modified_at", "_ingested_at").first()
    assert r["_source_file"].endswith("f1.csv") and r["_source_modified_at"] is not None
    assert df.where(F.col("_ingested_at").isNull()).count() == 0


def test_keyless_header_detection_with_many_splits(spark, scratch):
    """Without a key column a file's header is its first line, found as the smallest
    monotonically increasing id in block 0 — also when a file spans several splits and several
    small files share one partition."""
    from alpina.sources.delimited import header_signatures
    root = scratch("splits")
    _write(root, "big.csv", "a;b;c\n" + "".join(f"{i};{i};{i}\n" for i in range(20000)))
    _write(root, "small1.csv", "x;y\n1;2\n")
    _write(root, "small2.csv", "a;b;c\n3;4;5\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        groups = header_signatures(spark, root, ";")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {h: sorted(f.rsplit("/", 1)[1] for f in fs) for h, fs in groups.items()}
    assert got == {"a;b;c": ["big.csv", "small2.csv"], "x;y": ["small1.csv"]}


def test_catalog_assets_suffix_and_next_link(spark):
    import json
    from alpina.sources.web import catalog_assets, item_ids, next_link
    item = json.dumps({"assets": {"a.csv": {"href": "h1", "file:checksum": "1220ab", "updated": "u"},
                                  "b.json": {"href": "h2"}}})
    df = spark.createDataFrame([("_meta", item)], "folder string, json string")
    rows = [tuple(r) for r in catalog_assets(df, "json", "folder", suffix=".csv").collect()]
    assert rows == [("_meta", "a.csv", "h1", "1220ab", "u")]
    pages = spark.createDataFrame(
        [(json.dumps({"features": [{"id": "lug"}, {"id": "chz"}], "links": [{"rel": "next", "href": "p2"}]}),),
         (json.dumps({"features": [{"id": "abo"}], "links": [{"rel": "self", "href": "p2"}]}),)], "json string")
    assert [r["item_id"] for r in item_ids(pages, "json").collect()] == ["abo", "chz", "lug"]
    assert [r["n"] for r in pages.select(next_link("json").alias("n")).collect()] == ["p2", None]


def test_listing_in_tasks_equals_the_client_s(spark, scratch):
    import os
    from alpina.session import local_path
    from alpina.sources.files import _list_by_client, source_path
    root = local_path(scratch("tree"))
    names = ["a.csv", "b c.csv", "ü#1%2.csv", "x.txt", "_hidden.csv", "empty.csv", "[1].csv", "d&e=f.csv", "a,b.csv"]
    for folder in ("", "one", "one/two", "one/two/three", "_meta", "emp ty", *(f"many/{i}" for i in range(40))):
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        for n in names if folder not in ("emp ty",) else []:
            with open(f"{root}/{folder}/{n}", "w") as f:
                f.write("" if n == "empty.csv" else "h\n1\n")
    for pattern in ("*.csv", "*", "?.csv", "[ab]*", "[!a]*.csv", "{a,x}.*", "a,b*", "none"):
        got = sorted(map(tuple, list_files(spark, root, pattern).collect()))
        assert got == sorted(map(tuple, _list_by_client(spark, root, pattern).collect())), pattern
    listed = {r["path"] for r in list_files(spark, root, "*.csv").where("size > 0").collect()}
    read = spark.read.option("recursiveFileLookup", True).text(root, pathGlobFilter="*.csv").select(source_path().alias("f")).distinct()
    assert {r["f"] for r in read.collect()} == listed
    assert list_files(spark, f"{root}/nowhere").count() == 0
