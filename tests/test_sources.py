import os

import pytest

from corpreg.params import S1_NAME
from corpreg.sources import csv_sources


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


S1_HEADER = "corporate_name_S1,address,activity_places,top_suppliers\n"
S2_HEADER = "corporate_name_S2,main_customers,revenue,profit\n"


def test_route_and_read(spark, tmp_path):
    root = str(tmp_path)
    _write(f"{root}/a/s1_part1.csv", S1_HEADER + 'Acme Inc.,"1 Main St, X",a; b,"S1,S2"\n')
    _write(f"{root}/a/s1_part2.csv", S1_HEADER + "Beta LLC,,c,\n")
    _write(f"{root}/b/fin.csv", S2_HEADER + "ACME,Apple;Ford,1000000.0,150000.0\n")
    _write(f"{root}/notes.txt", "ignore me\n")
    _write(f"{root}/other.csv", "x,y\n1,2\n")
    files = [r["path"] for r in csv_sources.discover_sources(spark, root).collect()]
    assert len(files) == 4 and all(f.endswith(".csv") for f in files)
    s1, s2 = csv_sources.read_sources(spark, root)
    assert s1.count() == 2 and s2.count() == 1
    row = s1.where("corporate_name_S1 = 'Acme Inc.'").first()
    assert row["address"] == "1 Main St, X"
    s1_last, _ = csv_sources.read_sources(spark, root, policy="last")
    assert s1_last.count() == 1


def test_missing_role_raises(spark, tmp_path):
    _write(f"{tmp_path}/only.csv", S1_HEADER + "Acme,,,\n")
    with pytest.raises(csv_sources.MissingSourceError):
        csv_sources.read_sources(spark, str(tmp_path))


def test_reordered_header_raises(spark, tmp_path):
    p = f"{tmp_path}/fin.csv"
    _write(p, "corporate_name_S2,main_customers,profit,revenue\nA,b,1.0,2.0\n")
    from corpreg.schemas import FINANCIAL

    with pytest.raises(Exception):
        csv_sources.read_source(spark, p, FINANCIAL).collect()


def test_bad_number_raises_in_validation(spark, tmp_path):
    p = f"{tmp_path}/fin.csv"
    _write(p, S2_HEADER + "A,b,not_a_number,1.0\n")
    from corpreg.schemas import FINANCIAL

    df = csv_sources.read_source(spark, p, FINANCIAL)
    with pytest.raises(Exception):
        csv_sources.validated_counts(df)


def test_pipeline_gate_catches_bad_number(spark, tmp_path):
    from corpreg.plans.pipeline import run_pipeline
    from corpreg.session import scratch_path
    from corpreg.sources import fixtures

    _write(f"{tmp_path}/s1.csv", S1_HEADER + "Acme Inc.,1 Main St,a,b\n")
    _write(f"{tmp_path}/s2.csv", S2_HEADER + "Acme,x,1000000.0,oops\n")
    s1, s2 = csv_sources.read_sources(spark, str(tmp_path))
    with pytest.raises(Exception) as err:
        run_pipeline(spark, s1, s2, fixtures.headline_feed(spark), scratch_path(spark, "bad"), train=False)
    assert "oops" in str(err.value) or "FAILFAST" in str(err.value) or "MALFORMED" in str(err.value).upper()


def test_csv_landing_round_trip_gives_same_golden_records(spark, sf_small, tmp_path):
    from corpreg.operators.golden import golden_records
    from corpreg.sources import fixtures

    # an empty field of a CSV file is read as NULL
    s1 = fixtures.supply_chain(spark, sf_small).replace("", None)
    s2 = fixtures.financial(spark, sf_small).replace("", None)
    root = str(tmp_path / "landing")
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    s1.write.options(**options).csv(f"{root}/supply")
    s2.write.options(**options).csv(f"{root}/finance")
    c1, c2 = csv_sources.read_sources(spark, root)
    assert csv_sources.validated_counts(c1)["__rows"] == s1.count()
    want = sorted(golden_records(s1, s2).collect(), key=repr)
    got = sorted(golden_records(c1, c2).collect(), key=repr)
    assert got == want


def test_role_folders(spark, sf_small, tmp_path):
    from corpreg.sources import fixtures

    s1 = fixtures.supply_chain(spark, sf_small)
    s2 = fixtures.financial(spark, sf_small)
    s1.write.option("header", True).csv(str(tmp_path / "s1" / "day=1"))
    s2.write.option("header", True).csv(str(tmp_path / "s2"))
    c1, c2 = csv_sources.read_role_folders(spark, str(tmp_path / "s1"), str(tmp_path / "s2"))
    assert c1.count() == s1.count() and c2.count() == s2.count()
    assert c1.columns == s1.columns and c2.columns == s2.columns


def test_headers_of_all_kinds(spark, tmp_path):
    root = str(tmp_path)
    files = {
        "plain.csv": S1_HEADER + "Acme,,,\n",
        "deep/er/quoted.csv": '"corporate_name_S2","main ""big"" customers, all",revenue,profit\r\nA,b,1.0,2.0\r\n',
        "bom é+%20 1.csv": "\ufeff" + S1_HEADER + "Beta,,,\n",
        "blank_lines.csv": "\n  \n" + S2_HEADER + "C,d,1.0,1.0\n",
        "both.csv": "corporate_name_S2,corporate_name_S1\nx,y\n",
        "no_newline.csv": "corporate_name_S2",
        "empty.csv": "",
        "only_blank.csv": "\n\n",
        "inside.csv": "a,not_corporate_name_S1,corporate_name_S1x\n",
        "data_names.csv": "x,y\ncorporate_name_S1,corporate_name_S2\n",
        "ignored.txt": S1_HEADER,
    }
    for name, text in files.items():
        _write(f"{root}/{name}", text)
    got = {os.path.relpath(r["path"].removeprefix("file:"), root): list(r["columns"]) for r in csv_sources.headers(spark, root).collect()}
    assert got["plain.csv"] == S1_HEADER.strip().split(",") == got["bom é+%20 1.csv"]
    assert got["deep/er/quoted.csv"] == ["corporate_name_S2", 'main "big" customers, all', "revenue", "profit"]
    assert not {"empty.csv", "only_blank.csv", "ignored.txt"} & got.keys()
    routed = csv_sources.route_sources(spark, root)
    names = {role: sorted(os.path.basename(p) for p in files) for role, files in routed.items()}
    assert names == {"supply_chain": ["bom é+%20 1.csv", "both.csv", "plain.csv"], "financial": ["blank_lines.csv", "no_newline.csv", "quoted.csv"]}
    assert csv_sources.sniff_header(spark, f"{root}/plain.csv")[0] == S1_NAME and csv_sources.sniff_header(spark, f"{root}/empty.csv") == []
    assert csv_sources.route_sources(spark, []) == {"supply_chain": [], "financial": []}
    read = csv_sources.read_source(spark, [p for p in routed["supply_chain"] if "both" not in p], csv_sources.SUPPLY_CHAIN)
    assert sorted(r[0] for r in read.collect()) == ["Acme", "Beta"]


def test_a_thousand_landing_files_are_routed_by_one_job(spark, tmp_path):
    for i in range(1000):
        _write(f"{tmp_path}/{i % 10}/{i}.csv", (S1_HEADER if i % 3 else S2_HEADER) + f"name {i},,,\n")
    sc = spark.sparkContext
    sc.setJobGroup("routing", "routing")
    try:
        routed = csv_sources.route_sources(spark, str(tmp_path))
        jobs = sc.statusTracker().getJobIdsForGroup("routing")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(routed["supply_chain"]) == 666 and len(routed["financial"]) == 334
    assert len(jobs) <= 2  # the map stage and the result under adaptive execution; none for a file
