from cohortkit.plans.jobs import lift_report_job, main
from cohortkit.plans.lift_report import lift_stages
from tests.fixtures import D, frame, random_peer_world


def test_lift_job_writes_the_report(spark, tmp_path):
    facts, accounts, _ = random_peer_world()
    fact_path, acc_path, out = (str(tmp_path / n) for n in ("fact", "acc", "out"))
    frame(spark, "fact_funded", facts).write.parquet(fact_path)
    frame(spark, "dim_account", accounts).where("dealership_id__c IS NOT NULL").write.parquet(acc_path)
    lift_report_job(spark, fact_path, acc_path, D(2022, 1, 15), out, low=2, high=3)
    written = spark.read.parquet(out)
    direct = lift_stages(spark.read.parquet(fact_path), spark.read.parquet(acc_path), D(2022, 1, 15),
                         low=2, high=3).report
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, direct.collect()))


def test_snapshot_job_cli(spark, tmp_path):
    import datetime as dt
    rows = [(D(2021, 1, 1), 1, dt.datetime(2020, 12, 30), "Default"),
            (D(2021, 3, 1), 2, dt.datetime(2021, 2, 27), "Administrator")]
    hist, out = str(tmp_path / "hist"), str(tmp_path / "snaps")
    frame(spark, "user_hist", rows).write.parquet(hist)
    main(["snapshots", "--hist", hist, "--first", "2021-01-01", "--last", "2021-03-01",
          "--step", "2", "--out", out])
    assert spark.read.parquet(out).count() == 2


def test_contest_job_releases_what_it_persisted(spark, tmp_path):
    from cohortkit.plans.jobs import contest_job
    from cohortkit.plans.registry import CONTEST, _contest_sources
    from tests.conftest import SMOKE
    s = _contest_sources(spark, SMOKE, narrow=False)
    names = ("fact_funded", "fact_apps", "dim_account", "status_monthly", "region_rep",
             "manual_report", "bounty")
    inputs = {}
    for name, df in zip(names, (s.fact, s.apps, s.account, s.status, s.region_rep, s.manual_report, s.bounty)):
        inputs[name] = str(tmp_path / name)
        df.write.parquet(inputs[name])
    other = spark.range(3).persist()
    other.count()
    contest_job(spark, inputs, CONTEST, str(tmp_path / "dash"))
    from pyspark import StorageLevel
    assert other.storageLevel != StorageLevel.NONE     # the job releases only its own relations
    assert spark.read.parquet(str(tmp_path / "dash")).count() > 0
    other.unpersist()


def test_lift_job_cli(spark, tmp_path):
    facts, accounts, treated = random_peer_world()
    fact_path, acc_path, out = (str(tmp_path / n) for n in ("fact", "acc", "out"))
    frame(spark, "fact_funded", facts).write.parquet(fact_path)
    frame(spark, "dim_account", accounts).where("dealership_id__c IS NOT NULL").write.parquet(acc_path)
    main(["lift", "--fact", fact_path, "--account", acc_path, "--as-of", "2022-01-15",
          "--low", "2", "--high", "3", "--out", out])
    written = spark.read.parquet(out)
    assert {r.Dealership_ID for r in written.select("Dealership_ID").distinct().collect()} == set(treated)
