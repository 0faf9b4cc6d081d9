"""The jobs end to end, by their command lines."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from test_warehouse import drop, sale

from tillwright.jobs import main


def test_batch_jobs(spark, tmp_path, capsys):
    landing, database = tmp_path / "in", f"retail_{uuid.uuid4().hex}"
    drop(landing, "x", [sale("a"), sale("b", day="2024-01-01", offer_1="true")])
    drop(landing, "x", ["7,Ann,2020-01-01"], "sales_person_id,name,hire_date", "sales_agents")
    drop(landing, "x", ["3,Cairo,2019-05-05,A"], "branch_id,location,establish_date,class", "branches")
    as_of = (dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=5)).replace(tzinfo=None).isoformat()
    raw, dwh = str(tmp_path / "raw"), ["--warehouse", str(tmp_path / "dwh"), "--database", database]

    main(["land", "--landing", str(landing), "--raw", raw, "--as-of", as_of], spark)
    main(["load-hour", "--raw", raw, *dwh, "--as-of", as_of], spark)
    main(["marketing", *dwh, "--out", str(tmp_path / "marketing")], spark)
    assert str(tmp_path / "marketing") in capsys.readouterr().out
    assert [row[0] for row in spark.read.parquet(str(tmp_path / "marketing" / "most_redeemed_offers")).collect()] == ["offer_1"]
    main(["daily-report", *dwh, "--day", "2024-01-01", "--out", str(tmp_path / "daily")], spark)
    report, = (tmp_path / "daily" / "01-01-2024").glob("*.csv")
    assert report.read_text() == "sales_agent_name,product_name,total_units_sold\nAnn,lamp,2\n"


def test_stream_jobs(spark, tmp_path, capsys):
    log, database = tmp_path / "log", f"stream_{uuid.uuid4().hex}"
    log.mkdir()
    event = {"eventType": "productView", "customerId": "c", "productId": "p", "timestamp": "2024-01-01T10:00:00"}
    (log / "a.txt").write_text("\n".join(json.dumps(event) for _ in range(3)) + "\n")
    source = ["--source", "text", "--path", str(log), "--every", "once"]
    out = ["--out", str(tmp_path / "out"), "--database", database]

    main(["routes", *source, "--checkpoint", str(tmp_path / "c"), *out, "--with-unrouted"], spark)
    main(["kpis", *out, "--results", str(tmp_path / "kpis")], spark)
    assert "total_product_views" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "kpis" / "total_product_views")).first()[0] == 3
    assert spark.table(f"{database}.product_view").count() == 3
    target = ["--target", str(tmp_path / "compacted")]
    for _ in range(2):  # nothing new the second time
        main(["compact", *out, *target, "--as-of", "2024-01-01T00:00:00"], spark)
        assert any(str(tmp_path / "compacted") in f for f in spark.table(f"{database}.product_view").inputFiles())
        assert spark.table(f"{database}.product_view").count() == 3
    main(["retire", *target, "--hours", "1", "--as-of", "2024-01-01T02:00:00"], spark)
    assert spark.table(f"{database}.product_view").count() == 3
    for job in ("event-counts", "top-products"):
        served = str(tmp_path / job)
        main([job, *source, "--checkpoint", served + "-c", "--folder", served, "--state-partitions", "2"], spark)
        assert [row["count"] for row in spark.read.parquet(served).collect()] == [3]
        main(["retire-versions", "--of", job, "--folder", served], spark)
        assert [row["count"] for row in spark.read.parquet(served).collect()] == [3]
        main(["versions-view", "--of", job, "--view", "newest", "--jdbc-table", "versions"], spark)
    assert "CREATE VIEW newest" in capsys.readouterr().out


def test_bounded_jobs(spark, tmp_path, capsys):
    log = tmp_path / "log"
    log.mkdir()
    for hour in (10, 12):
        event = {"eventType": "productView", "customerId": "c", "productId": "p", "timestamp": f"2024-01-01T{hour}:00:00"}
        (log / f"{hour}.txt").write_text("\n".join(json.dumps(event) for _ in range(2)) + "\n")
    source = ["--source", "text", "--path", str(log), "--every", "once", "--state-partitions", "2", "--closed"]
    for job in ("event-counts", "top-products"):
        served = str(tmp_path / job)
        main([job, *source, "--checkpoint", served + "-c", "--folder", served], spark)
        assert [row["count"] for row in spark.read.parquet(served).collect()] == [2]
    main(["latest-window", "--folder", str(tmp_path / "top-products"), "--out", str(tmp_path / "top")], spark)
    assert [row["productId"] for row in spark.read.parquet(str(tmp_path / "top" / "latest_window")).collect()] == ["p"]
