"""Lists of cases with and without headers, against the rules applied row by row."""

from pyspark.sql import functions as F

from siftwell.sources import case_lists
from tests.test_sources import put

FILES = {
    "header.csv": '# comment\n\n Case_ID , REPO_PATH,label,branch,tags_json,tags,commit\nOne, /r/one ,L1,main,"{""set"": ""core"", ""a"": 1}",,c1\n,/r/sub/two/,,,"[1]",\n#three,/r/three\nfour,,x\n , ,\nfive,/r/five,,,,"{""own"": true}"\n',
    "urls.csv": "repo_url,repo_key,case_id,runs_repo_name,label,repo_path\nhttps://h/x/juice-shop.git/,,,,\nhttps://h/y,Key A,,my runs,Label\n,,only,,\nhttps://h/123.git,,,,,\nhttps://h/z,k,named,,,/p/q\n",
    "places.csv": "/r/alone\ncase 2,/r/two\n  # hidden , x\ncase/3,/r/three,,dev,trk,\"{\"\"b\"\": [1]}\"\n..,/r/up\n.env,/r/x,,\n",
    "twice.csv": "repo_path,label,repo_path\n/first,l,/second\n",
    "comments.csv": "# only\n\n",
    "upper.csv": "REPO_KEY\nABC\n",
}


def lists(spark, root):
    found = case_lists.read_case_lists(spark, str(root)).orderBy("list", "place")
    out = {}
    for r in found.collect():
        out.setdefault(r["list"].rpartition("/")[2], []).append({c: r[c] for c in case_lists.COLUMNS if r[c]})
    return out


def test_lists_of_every_form(spark, tmp_path):
    for name, text in FILES.items():
        put(tmp_path, name, text)
    got = lists(spark, tmp_path)
    assert got["header.csv"] == [
        {"case_id": "One", "runs_repo_name": "One", "label": "L1", "repo_path": "/r/one", "branch": "main", "commit": "c1", "tags_json": '{"a":1,"set":"core"}'},
        {"case_id": "two", "runs_repo_name": "two", "label": "two", "repo_path": "/r/sub/two/", "tags_json": "{}"},
        {"case_id": "five", "runs_repo_name": "five", "label": "five", "repo_path": "/r/five", "tags_json": '{"own":true}'},
    ]
    assert got["urls.csv"] == [
        {"case_id": "juice_shop", "runs_repo_name": "juice_shop", "label": "juice_shop", "repo_url": "https://h/x/juice-shop.git/", "tags_json": "{}"},
        {"case_id": "Key_A", "runs_repo_name": "my_runs", "label": "Label", "repo_url": "https://h/y", "repo_key": "Key A", "tags_json": "{}"},
        {"case_id": "p_123", "runs_repo_name": "p_123", "label": "p_123", "repo_url": "https://h/123.git", "tags_json": "{}"},
        {"case_id": "named", "runs_repo_name": "named", "label": "named", "repo_path": "/p/q", "tags_json": "{}"},
    ]
    assert got["places.csv"] == [
        {"case_id": "alone", "runs_repo_name": "alone", "label": "alone", "repo_path": "/r/alone", "tags_json": "{}"},
        {"case_id": "case_2", "runs_repo_name": "case_2", "label": "case_2", "repo_path": "/r/two", "tags_json": "{}"},
        {"case_id": "case_3", "runs_repo_name": "case_3", "label": "case_3", "repo_path": "/r/three", "branch": "dev", "track": "trk", "tags_json": '{"b":[1]}'},
        {"case_id": "unknown", "runs_repo_name": "unknown", "label": "unknown", "repo_path": "/r/up", "tags_json": "{}"},
        {"case_id": "env", "runs_repo_name": "env", "label": "env", "repo_path": "/r/x", "tags_json": "{}"},
    ]
    assert got["twice.csv"][0]["repo_path"] == "/second" and got["upper.csv"][0]["case_id"] == "ABC"
    assert set(got) == set(FILES) - {"comments.csv"}


def test_no_rows(spark):
    rows = spark.createDataFrame([("a", 0, ["", None]), ("b", 0, ["# x"]), ("c", 0, ["repo_path"]), ("d", 0, [])], "list string, place long, cells array<string>")
    assert case_lists.cases_of(rows).count() == 0 and case_lists.cases_of(rows.limit(0)).count() == 0


def test_safe_names(spark):
    names = {" a b ": "a_b", "a//b__c": "a_b_c", ".": "unknown", "..": "unknown", "": "unknown", None: "unknown", ".env": "env", "__": "unknown", "a:b-c.d": "a:b-c.d", "é": "unknown"}
    rows = spark.createDataFrame([(k,) for k in names], "n string")
    assert {r["n"]: r["s"] for r in rows.select("n", case_lists.safe_name(F.col("n")).alias("s")).collect()} == names
