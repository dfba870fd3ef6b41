"""Raw files to answers, and run logs to scaling tables."""

import gzip
import json
from types import SimpleNamespace

import pytest

from rentlens import __main__ as cli
from rentlens.plans import ingestion, market, scaling, workloads
from rentlens.sources import run_logs, scratch, tables

CITIES = {"porto": "Porto", "lisbon": "Lisbon"}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("market")
    head = (
        "id,host_id,neighbourhood_group,neighbourhood,latitude,longitude,room_type,price,minimum_nights,"
        "number_of_reviews,reviews_per_month,calculated_host_listings_count,availability_365,number_of_reviews_ltm"
    )
    for city, folder in CITIES.items():
        extra = ",license" if city == "porto" else ""
        rows = [
            f'{city}{i},h{i % 7},G,"N, ""{i % 2}""\nwest",41.{i},-8.{i},Private room,${50 + i}.00,2,{i},0.5,{i % 3},{i * 3},1'
            + (",x" if extra else "")
            for i in range(40)
        ]
        suffix = ".csv" if city == "porto" else ".csv.gz"
        write(root / "raw" / folder / f"listings{suffix}", "\n".join([head + extra, *rows]) + "\n")
        days = [f"{city}{i},2025-0{m}-{d:02d},{'t' if (i + d) % 3 else 'f'},," for i in range(40) for m in (1, 2) for d in range(1, 4)]
        write(root / "raw" / folder / "calendar.csv", "\n".join(["listing_id,date,available,price,adjusted_price", *days]) + "\n")
        seen = [f"{city}{i},{2018 + i % 3}-05-0{1 + i % 9}" for i in range(40)]
        write(root / "raw" / folder / "reviews.csv", "\n".join(["listing_id,date", *seen, seen[0]]) + "\n")
        areas = [f'G,"N, ""{i}""\nwest"' for i in range(2)]
        write(root / "raw" / folder / "neighbourhoods.csv", "\n".join(["neighbourhood_group,neighbourhood", *areas]) + "\n")
    write(
        root / "raw" / "Porto" / "listings-detailed.csv",
        'id,price,beds,amenities,host_is_superhost\nporto1,"$1,051.00",3,"[""a"", ""b, c""]",t\n',
    )
    raw, interim, processed = (str(root / z) for z in ("raw", "interim", "processed"))
    ingestion.ingest(spark, raw, interim, CITIES)
    ingestion.clean(spark, interim, processed, raw, CITIES)
    return root


def test_ingested_tables_keep_common_columns(spark, root):
    listings = tables.read_table(spark, str(root / "interim" / "listings"))
    assert "license" not in listings.columns and listings.count() == 80
    assert {r[0] for r in listings.select("neighbourhood").distinct().collect()} == {'N, "0"\nwest', 'N, "1"\nwest'}


def test_cleaned_tables(spark, root):
    m = market.Market.load(spark, str(root / "processed"))
    row = m.listings.where("id = 'porto1'").first()
    assert (row["price"], row["beds"], row["amenity_count"], row["host_is_superhost"]) == (1051.0, 3.0, 2, True)
    assert m.listings.count() == 80 and m.calendar.count() == 480
    assert m.reviews.count() == 80 and m.neighbourhoods.count() == 4


def test_every_question_and_workload_answers(spark, root):
    m = market.Market.load(spark, str(root / "processed"))
    market.answer(m, str(root / "results"), single_csv=True)
    for q in market.QUESTIONS:
        stored = tables.read_table(spark, str(root / "results" / f"{q}.parquet"))
        assert stored.count() > 0 or q == "q06"
        assert len(list((root / "results" / f"{q}.csv").glob("part-*.csv"))) == 1
    assert market.peak_demand(m).count() == 2
    for name in set(workloads.WORKLOADS) - {"train_rf"}:
        assert workloads.WORKLOADS[name](m).count() > 0
    with pytest.raises(KeyError):
        market.ask(m, "q99")


def test_command_line(spark, root):
    place = ["--root", str(root)]
    cli.main([*place, "ingest", "--cities", "porto", "lisbon"])
    cli.main([*place, "clean", "--cities", "porto", "lisbon"])
    cli.main([*place, "ask", "q05"])
    cli.main([*place, "workload", "query_seasonality"])
    cli.main([*place, "train", "price", "--algo", "lr"])
    cli.main([*place, "score", "price_lr"])
    assert tables.read_table(spark, str(root / "results" / "scores_price_lr")).count() == 80
    with pytest.raises(SystemExit):
        cli.main([*place, "workload", "other"])


def test_account_beside_the_cleaned_tables(spark, root, tmp_path):
    """Every listing of Lisbon lacks nothing, so the account is of the day rows, which name no price."""
    raw, interim, processed = str(root / "raw"), str(tmp_path / "interim"), str(tmp_path / "processed")
    ingestion.ingest(spark, raw, interim, CITIES, keep_malformed=True)
    ingestion.clean(spark, interim, processed, raw, CITIES, account=True)
    for name in ingestion.DATASETS:
        mine, plain = (tables.read_table(spark, f"{p}/{name}") for p in (processed, str(root / "processed")))
        assert sorted(map(str, mine.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
        assert set(mine.columns) == set(plain.columns)
    counts = {(r.dataset, r.column): r for r in tables.read_table(spark, f"{processed}/account").collect()}
    assert counts["listings", "price"].n_rows == 80 and counts["calendar", "adjusted_price"].n_missing == 480
    assert {r.n_unreadable for r in counts.values()} == {0} and counts["reviews", "date"].n_rows == 82


def test_missing_files_are_named(spark, root):
    with pytest.raises(FileNotFoundError, match="absent"):
        tables.find_csv(spark, str(root / "raw" / "Porto"), "absent")


def test_run_logs(spark, tmp_path):
    times = {("scan", 1): [75.696, 22.4026, 20.8369], ("scan", 4): [44.5657, 17.0917, 9.7748], ("join", 2): [8.0, 6.0]}
    for (workload, workers), runs in times.items():
        block = {"workload": workload, "runs": [{"run": i, "wall_secs": t} for i, t in enumerate(runs)]}
        text = f"noise\n===RESULT===\n{json.dumps(block, indent=2)}\n===END===\n"
        (tmp_path / f"{workload}_{workers}w.txt").write_text(text)
    (tmp_path / "notes.txt").write_text('"wall_secs": 1.0\n')
    runs = run_logs.read_run_logs(spark, str(tmp_path))
    out = {(r["workload"], r["workers"]): r for r in scaling.scaling_summary(runs).collect()}
    assert set(out) == set(times)
    one, four, two = out["scan", 1], out["scan", 4], out["join", 2]
    assert (one["runs"], one["median_wall_secs"], one["speedup"]) == (3, 22.4026, 1.0)
    assert (four["min_wall_secs"], four["max_wall_secs"]) == (9.7748, 44.5657)
    assert (four["speedup"], four["efficiency"]) == (1.3107, 0.3277)
    assert (two["median_wall_secs"], two["speedup"], two["efficiency"]) == (7.0, None, None)
    best = {r["workload"]: r["best_config"] for r in scaling.fastest_configuration(scaling.scaling_summary(runs)).collect()}
    assert best == {"scan": "4 workers", "join": "2 workers"}


def test_scratch_follows_the_configured_folder(spark):
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")

    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert scratch.new_folder(session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError):
        scratch.new_folder(session("yarn", None), "x")


def test_log_names_are_parsed_once_per_file(spark, tmp_path):
    """A name is looked at in a table of files; lines of logs under another naming and of encoded paths are told apart."""
    for name, secs in (("my load_2w.txt", "1.5"), ("a_1w.txt", "2"), ("a_1w.log", "9")):
        (tmp_path / name).write_text(f'"wall_secs": {secs},\n"run": 1\n')
    runs = run_logs.read_run_logs(spark, str(tmp_path))
    assert sorted(map(tuple, runs.collect())) == [("a", 1, 2.0), ("my load", 2, 1.5)]
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "rlike" not in plan.split("Join Inner")[0].lower()
