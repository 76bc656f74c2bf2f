from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from changeledger.operators.contributors import flatten_contributors
from changeledger.plans.commits import CommitsJob, build_project_stats, contributor_stats, run_commits_job, select_projects
from changeledger.schemas import COMMIT_CHANGE
from changeledger.sinks.documents import Target
from changeledger.sources.audit_logs import read_audit_log
from changeledger.sources.contributors import drop_blank_lines, landing_location, read_contributor_lines, with_source
from changeledger.sources.csv_lists import read_aliases, read_user_types
from changeledger.sources.manifest import read_manifest
from changeledger.sources.server_pages import read_accounts, read_known_projects, read_project_listing

PREFIX = ")]}'\n"
EVENT = (
    '{"type":"SshAuditEvent","event":{"session_id":"s","what":"%s","time_at_start":1,"elapsed":1,'
    '"uuid":{"uuid":"u"},"result":"0"}}\n'
)
PROJECT = "id string, name string, ref_name string"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_audit_log_directory_with_gzip(spark, tmp_path):
    write(tmp_path / "a.log", EVENT % "plain" + "broken\n\n")
    with gzip.open(tmp_path / "b.log.gz", "wt") as file:
        file.write(EVENT % "zipped")
    assert sorted(r.what for r in read_audit_log(spark, str(tmp_path)).collect()) == ["plain", "zipped"]
    assert [r.what for r in read_audit_log(spark, str(tmp_path / "b.log.gz")).collect()] == ["zipped"]


def test_project_sources(spark, rows):
    projects = spark.createDataFrame([("lib%2Fcore+x", "lib/core x", None), ("tool", "tool", "refs/tags/7"), ("app", "app", "")], PROJECT)
    at = with_source(projects, landing_location("/land"))
    assert rows(at) == [
        ("app", None, "/land/project=app/ref=__HIVE_DEFAULT_PARTITION__"),
        ("lib/core x", None, "/land/project=lib%2Fcore%20x/ref=__HIVE_DEFAULT_PARTITION__"),
        ("tool", "refs/tags/7", "/land/project=tool/ref=refs%2Ftags%2F7"),
    ]
    assert {r.source for r in with_source(projects, landing_location(None)).collect()} == {None}
    custom = with_source(projects, lambda i, n, r: F.concat(F.lit("at:"), i, F.coalesce(r, F.lit(""))))
    assert sorted(r.source for r in custom.collect()) == ["at:app", "at:lib%2Fcore+x", "at:toolrefs/tags/7"]


ODD_NAMES = ["lib/core", "two words", "a+b", "50%", "x*y", "007", "é"]


def test_contributor_lines_of_odd_names(spark, tmp_path, rows):
    """Landed where `landing_location` says, every name comes back as it was."""
    projects = spark.createDataFrame([(n, None) for n in ODD_NAMES] + [("absent", None), (None, None)], "name string, ref_name string")
    projects = projects.select(F.url_encode("name").alias("id"), "name", "ref_name")
    sources = with_source(projects, landing_location(str(tmp_path)))
    for row in sources.where("project <> 'absent'").collect():
        write(tmp_path / row.source.removeprefix(f"{tmp_path}/") / "1.json", '{"of":"%s"}\n\n  \t \n' % row.project)
    write(tmp_path / "project=unwanted" / "ref=main" / "1.json", '{"no":1}\n')
    lines = read_contributor_lines(spark, str(tmp_path), sources)
    assert rows(lines) == sorted((n, None, '{"of":"%s"}' % n) for n in ODD_NAMES)
    assert read_contributor_lines(spark, str(tmp_path), with_source(projects, landing_location(None))).count() == 0


def test_contributor_lines_of_one_ref(spark, tmp_path, rows):
    for ref in ("main", "refs%2Ftags%2F7", "__HIVE_DEFAULT_PARTITION__"):
        write(tmp_path / "project=tool" / f"ref={ref}" / "1.json", '{"name":"%s"}\n' % ref)
    write(tmp_path / "project=app" / "ref=main" / "1.json", '{"name":"app","starting_revision":"own"}\n')
    projects = spark.createDataFrame([("tool", "tool", "refs/tags/7"), ("tool", "tool", ""), ("app", "app", "main"), ("app", "app", "gone")], PROJECT)
    lines = read_contributor_lines(spark, str(tmp_path), with_source(projects, landing_location(str(tmp_path))))
    shown = flatten_contributors(lines).select("project", "author", "starting_revision")
    assert rows(shown) == [("app", "app", "own"), ("tool", "__HIVE_DEFAULT_PARTITION__", None), ("tool", "refs%2Ftags%2F7", "refs/tags/7")]


def test_job_without_a_target(spark):
    with pytest.raises(ValueError, match="output_dir"):
        run_commits_job(spark, CommitsJob(landing_root="x"))


def test_blank_lines(spark, rows):
    df = spark.createDataFrame([("LineOne",), ("",), ("LineTwo",), ("   ",), ("\t",)], "value string")
    assert rows(drop_blank_lines(df)) == [("LineOne",), ("LineTwo",)]


def test_project_listing_with_trailing_commas(spark, tmp_path, rows):
    path = write(tmp_path / "l.json", PREFIX + '{\n "All-x": {\n  "id": "All-y",\n },\n "T, }": {\n  "id": "T-id"\n }\n}\n')
    assert rows(read_project_listing(spark, path)) == [("All-y", "All-x", None), ("T-id", "T, }", None)]


def test_prefix_is_dropped_whatever_it_is(spark, tmp_path, rows):
    path = write(tmp_path / "l.json", '12345{"a": {"id": "i"}}')
    assert rows(read_project_listing(spark, path)) == [("i", "a", None)]


def test_known_projects_are_the_union_of_pages(spark, tmp_path, rows):
    write(tmp_path / "1.json", PREFIX + '[{"name": "a/b", "state": "ACTIVE"}, {"name": "c"}]')
    write(tmp_path / "2.json", PREFIX + '[{"name": "c", "state": "READ_ONLY"}, {"name": "d", "state": "HIDDEN"}]')
    assert rows(read_known_projects(spark, str(tmp_path))) == [("a/b",), ("c",)]


@pytest.mark.parametrize("read", [read_known_projects, read_accounts, read_project_listing])
def test_bad_page_fails_the_load(spark, tmp_path, read):
    write(tmp_path / "1.json", PREFIX + "[{")
    with pytest.raises(Exception, match="(?i)malformed"):
        read(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    "read, bodies",
    [
        (read_known_projects, ["", "  ", '{"name": "a"}', '[{"state": "ACTIVE"}]', '[{"name": null}]']),
        (read_accounts, ["", '{"_account_id": 1}', '[{"name": "A"}]', '[{"_account_id": null}]']),
        (read_project_listing, ["", "[]", '{"a": {}}', '{"a": {"id": null}}']),
    ],
)
def test_other_shapes_fail_the_load(spark, tmp_path, read, bodies):
    for number, body in enumerate(bodies):
        path = write(tmp_path / str(number) / "page1.json", PREFIX + body)
        with pytest.raises(Exception, match="(?i)malformed"):
            read(spark, path).collect()
    with pytest.raises(ValueError, match="empty"):
        read(spark, write(tmp_path / "none" / "page1.json", ""))


def test_the_later_page_has_the_larger_number(spark, tmp_path, rows):
    for number, name in [(2, "old"), (10, "new"), (9, "older")]:
        write(tmp_path / f"page{number}.json", PREFIX + f'[{{"_account_id": 8, "name": "{name}"}}]')
    assert rows(read_accounts(spark, str(tmp_path))) == [(8, "new")]


def test_accounts(spark, tmp_path, rows):
    write(
        tmp_path / "1.json",
        PREFIX
        + '[{"_account_id": 1, "name": "One", "email": "e1", "username": "u1"},'
        + '{"_account_id": 2, "email": "e2", "username": "u2"}, {"_account_id": 3, "username": "u3"},'
        + '{"_account_id": 4}, {"_account_id": 5, "name": "", "email": "e5"}, {"_account_id": 6, "name": "first"},'
        + '{"_account_id": 7, "name": "old"}, {"_account_id": 7, "name": "new"}]',
    )
    write(tmp_path / "2.json", PREFIX + '[{"_account_id": 6, "name": "later", "_more_accounts": true}]')
    expected = [(1, "One"), (2, "e2"), (3, "u3"), (4, "4"), (5, ""), (6, "later"), (7, "new")]
    assert rows(read_accounts(spark, str(tmp_path))) == expected


def test_alias_list(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", 'organization,author,email\n"Jo, Inc",007,j@x.y\n,Ann,a@x.y\n')
    df = read_aliases(spark, path)
    assert df.columns == ["author", "email", "organization"]
    assert rows(df) == [("007", "j@x.y", "Jo, Inc"), ("Ann", "a@x.y", None)]
    assert read_aliases(spark, None) is None
    with pytest.raises(ValueError, match="organization"):
        read_aliases(spark, write(tmp_path / "b.csv", "author,email\nA,a@x.y\n"))


def test_user_types(spark, tmp_path, rows):
    path = write(tmp_path / "u.csv", 'id,type\n123,"bot"\n456,\n789,\'human\'\n123,service\n')
    assert rows(read_user_types(spark, path)) == [(123, "service"), (456, "human"), (789, "'human'")]
    assert read_user_types(spark, None) is None
    with pytest.raises(Exception, match="(?i)malformed"):
        read_user_types(spark, write(tmp_path / "bad.csv", "id,type\nx,bot\n")).collect()


MANIFEST = """<?xml version="1.0"?>
<manifest>
 <remote name="r" fetch="."/>
 <default revision=" master " remote="r"/>
 <project name="tools.git" path="t"><linkfile src="a" dest="b"/></project>
 <project name="prefix/util.git" path="u"/>
 <project name="twice.git.git" path="u"/>
 <project name="tagged" remote="r" revision="refs/tags/v1" path="g" upstream="master"/>
 <project name="tagged" revision="refs/tags/v1" path="elsewhere"/>
 <project path="nameless"/>
 <group><project name="nested"/></group>
</manifest>"""


def test_manifest(spark, tmp_path, rows):
    path = write(tmp_path / "m.xml", MANIFEST)
    assert rows(read_manifest(spark, path)) == [
        ("prefix%2Futil", "prefix/util", "master"),
        ("tagged", "tagged", "refs/tags/v1"),
        ("tools", "tools", "master"),
        ("twice.git", "twice.git", "master"),
    ]


@pytest.mark.parametrize("text", ["<manifest><project name='a'/>", "<manifest><project name='a'></manifest>", "", "<other><project name='a'/></other>"])
def test_broken_manifest_fails_the_load(spark, tmp_path, text):
    write(tmp_path / "good.xml", '<manifest><project name="fine"/></manifest>')
    write(tmp_path / "odd.xml", text)
    with pytest.raises(Exception, match="(?i)malformed|failed|error"):
        read_manifest(spark, str(tmp_path)).collect()
    job = CommitsJob(landing_root=str(tmp_path / "land"), manifest=str(tmp_path / "odd.xml"), output_dir=str(tmp_path / "out"))
    write(tmp_path / "land" / "project=a" / "ref=main" / "1.json", "{}\n")
    with pytest.raises(Exception, match="(?i)malformed|failed|error"):
        run_commits_job(spark, job)


def test_manifest_names_keep_their_blanks(spark, tmp_path, rows):
    path = write(tmp_path / "m.xml", '<manifest><project name=" a "/></manifest>')
    assert [r.name for r in read_manifest(spark, path).collect()] == [" a "]


def test_manifest_without_default(spark, tmp_path, rows):
    path = write(tmp_path / "m.xml", '<manifest><project name="a"/><project name="b" revision="r"/></manifest>')
    assert rows(read_manifest(spark, path)) == [("a", "a", ""), ("b", "b", "r")]


def test_project_selection(spark, tmp_path, rows):
    manifest = write(tmp_path / "m.xml", '<manifest><project name="m"/></manifest>')
    listing = write(tmp_path / "l.json", PREFIX + '{"ab": {"id": "ab"}, "cd": {"id": "cd"}}')
    assert rows(select_projects(spark, CommitsJob(manifest=manifest, listing_path=listing))) == [("m", "m", "")]
    assert rows(select_projects(spark, CommitsJob(listing_path=listing, prefix="a"))) == [("ab", "ab", None)]
    assert rows(select_projects(spark, CommitsJob())) == []
    assert contributor_stats(spark, select_projects(spark, CommitsJob()), None).count() == 0


def test_commits_job(spark, tmp_path, rows):
    line = '{"name":"ada","email":"ada@corp.com","num_commits":1,"last_commit_date":5,"commits":[{"sha1":"x"}]}'
    write(tmp_path / "land" / "project=m" / "ref=__HIVE_DEFAULT_PARTITION__" / "1.json", line + "\n\n" + line.replace("ada", "bob") + "\n")
    write(tmp_path / "land" / "project=z" / "ref=main" / "1.json", line + "\n")
    manifest = write(tmp_path / "m.xml", '<manifest><project name="m"/></manifest>')
    aliases = write(tmp_path / "a.csv", "author,email,organization\nAda L,ada@corp.com,Big\n")
    job = CommitsJob(
        landing_root=str(tmp_path / "land"), manifest=manifest, manifest_label="rel", email_aliases=aliases,
        output_dir=str(tmp_path / "out"), index=Target(str(tmp_path / "index"), "parquet"),
    )
    assert run_commits_job(spark, job, count=True) == 2
    stats = build_project_stats(spark, job)
    assert "commits" not in stats.columns and stats.columns[-1] == "manifest_label"
    expected = [("Ada L", "big", "rel"), ("bob", "corp", "rel")]
    assert rows(stats.select("author", "organization", "manifest_label")) == expected
    assert rows(spark.read.parquet(str(tmp_path / "index")).select("author", "organization", "manifest_label")) == expected
    documents = spark.read.text(str(tmp_path / "out")).collect()
    assert len(documents) == 2 and not any("null" in d.value or "branches" in d.value for d in documents)
    # A branch or label without a manifest tags nothing.
    untagged = build_project_stats(spark, CommitsJob(landing_root=str(tmp_path / "land"), manifest_label="rel", manifest_branch="b"))
    assert "manifest_label" not in untagged.columns and "manifest_branch" not in untagged.columns


def test_commits_job_over_changes(spark, tmp_path, rows):
    changes = spark.createDataFrame(
        [
            ("m", "ada", "ada@corp.com", "c1", 1_514_764_800_000, False, "f1", 1, 2, ["main"]),
            ("m", "ada", "ada@corp.com", "c2", 1_514_764_800_000, True, "f1", 1, 2, ["dev", "main"]),
            ("m", "ada", "ada@corp.com", "c3", 1_577_836_800_000, False, "f2", 1, 2, ["main"]),
            ("z", "ada", "ada@corp.com", "c4", 1_514_764_800_000, False, "f2", 1, 2, ["main"]),
        ],
        COMMIT_CHANGE,
    )
    changes.write.parquet(str(tmp_path / "changes"))
    listing = write(tmp_path / "l.json", PREFIX + '{"m": {"id": "m"}, "z": {"id": "z"}}')
    job = CommitsJob(
        changes_path=str(tmp_path / "changes"), listing_path=listing, prefix="m", aggregate="email_year",
        until="2019-01-01", extract_branches=True,
    )
    stats = build_project_stats(spark, job)
    shown = stats.select("project", "author", "organization", "year", "num_commits", "num_distinct_files", "branches")
    assert rows(shown) == [("m", "ada", "corp", 2018, 2, 1, ("dev", "main"))]
    scan = stats._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(date," in scan
    with pytest.raises(ValueError, match="changes_path"):
        CommitsJob(landing_root="x", since="2018-01-01")
