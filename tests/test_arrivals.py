"""The ledger of landed files, and the jobs that read by it."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tests.test_jobs import land, obj, page, run
from tidemark import jobs
from tidemark.operators.history import HISTORY_COLUMNS
from tidemark.plans.history import History
from tidemark.plans.store import Store
from tidemark.sinks.commits import Commits
from tidemark.sources.arrivals import Arrivals, reached_end
from tidemark.workloads.registry import utc

D1, D2, D3 = "2024-05-02T00:00:00", "2024-05-03T00:00:00", "2024-05-04T00:00:00"


def lines(path, feed, name, *texts):
    folder = path / "landing" / feed
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def marks(spark, path):
    found = Store(spark, str(path / "store")).watermarks().collect()
    return {r["module"]: f"{r['last_synced_at']:%Y-%m-%d}" for r in found}


def results(path, job, run_id, at):
    return {r.label: r for r in run(path, job, run_id, at)}


class TestModules:
    def test_older_pages_that_come_later_are_loaded(self, spark, tmp_path):
        land(tmp_path, "Deals", page({"id": "1", "Amount": 1, "Modified_Time": "2024-01-10T00:00:00Z"}, number=1, more=True))
        first = results(tmp_path, "modules", "r0", D1)["Deals"]
        assert (first.status, first.records, first.complete, first.watermark) == ("synced", 1, False, None)
        assert "Deals" not in marks(spark, tmp_path)
        land(tmp_path, "Deals", page({"id": "2", "Amount": 2, "Modified_Time": "2024-01-05T00:00:00Z"}, number=2))
        second = results(tmp_path, "modules", "r1", D2)["Deals"]
        assert (second.records, second.complete) == (1, True)
        # The mark goes to the newest time of the whole fetch.
        assert marks(spark, tmp_path)["Deals"] == "2024-01-10"
        store = Store(spark, str(tmp_path / "store"))
        assert rows(store.read("Deals").select("id", "Amount")) == [("1", 1), ("2", 2)]
        third = results(tmp_path, "modules", "r2", D3)["Deals"]
        assert (third.status, third.records, third.complete) == ("idle", 0, True)

    def test_an_older_version_that_comes_later_does_not_win(self, spark, tmp_path):
        for run_id, at, time, amount in (("r0", D1, "2024-01-10T00:00:00Z", 1), ("r1", D2, "2024-01-05T00:00:00Z", 2)):
            land(tmp_path, "Deals", page({"id": "1", "Amount": amount, "Modified_Time": time}))
            run(tmp_path, "modules", run_id, at)
        assert rows(Store(spark, str(tmp_path / "store")).read("Deals").select("id", "Amount")) == [("1", 1)]

    def test_bad_lines_count_in_one_run(self, spark, tmp_path):
        for k in range(3):
            lines(tmp_path, "Deals", f"f{k}.json", json.dumps(page({"id": str(k), "Modified_Time": D1 + "Z"})), *["{bad"] * 6)
            found = results(tmp_path, "modules", f"r{k}", D1)["Deals"]
            assert found.status == "synced"
        store = Store(spark, str(tmp_path / "store"))
        assert store.read("Deals").count() == 3 and store.quarantined().count() == 18

    def test_too_many_bad_lines_skip_the_feed_until_it_is_mended(self, spark, tmp_path):
        good = json.dumps(page({"id": "1", "Modified_Time": D1 + "Z"}))
        lines(tmp_path, "Deals", "f.json", good, *["{bad"] * 11)
        assert results(tmp_path, "modules", "r0", D1)["Deals"].status == "skipped"
        lines(tmp_path, "Deals", "f.json", good)
        assert results(tmp_path, "modules", "r1", D2)["Deals"].records == 1

    def test_a_reset_reads_all_files_again(self, spark, tmp_path):
        land(tmp_path, "Deals", page({"id": "1", "Modified_Time": D1 + "Z"}))
        run(tmp_path, "modules", "r0", D1)
        argv = ["reset", "--landing", str(tmp_path / "landing"), "--store", str(tmp_path / "store"), "--module", "Deals"]
        assert jobs.main(argv) == [] and "Deals" not in marks(spark, tmp_path)
        assert results(tmp_path, "modules", "r1", D2)["Deals"].records == 1
        assert results(tmp_path, "modules", "r2", D3)["Deals"].status == "idle"

    def test_a_lookback_limits_the_first_run_only(self, spark, tmp_path):
        old, new = "2024-01-01T00:00:00Z", "2024-05-01T00:00:00Z"
        argv = ["modules", "--landing", str(tmp_path / "landing"), "--store", str(tmp_path / "store"), "--lookback-days", "30"]
        land(tmp_path, "Deals", page({"id": "1", "Modified_Time": old}, {"id": "2", "Modified_Time": new}, {"id": "3", "Modified_Time": "?"}))
        jobs.main([*argv, "--run-id", "r0", "--at", D1])
        land(tmp_path, "Deals", page({"id": "4", "Modified_Time": old}))
        jobs.main([*argv, "--run-id", "r1", "--at", D2])
        assert rows(Store(spark, str(tmp_path / "store")).read("Deals").select("id")) == [("2",), ("3",), ("4",)]


class TestHistory:
    def records(self, *items):
        return page(*[{"id": i, "Amount": a, "Date": "d", "Modified_Time": f"2024-05-0{k}T00:00:00Z"} for i, a, k in items])

    def test_a_run_compares_with_the_state_not_the_log(self, spark, tmp_path):
        for k, batch in enumerate(([("1", 5, 1), ("2", 6, 1)], [("1", 7, 2)], [("2", 6, 3), ("3", 1, 3)])):
            land(tmp_path, "Revenue_Recognition", self.records(*batch))
            run(tmp_path, "modules", f"r{k}", f"2024-0{k + 5}-05T00:00:00")
        history = History(Store(spark, str(tmp_path / "store")))
        assert rows(history.read().select("revenue_id", "Type", "amount")) == sorted(
            [("1", "Create", "5"), ("2", "Create", "6"), ("1", "Amount changed", "7"), ("3", "Create", "1")], key=repr
        )
        assert rows(history.previous().select("id", "amount")) == [("1", "7"), ("2", "6"), ("3", "1")]
        text = plan(history.previous())
        assert "history/state" in text and "history/log" not in text
        months = {p.name for p in (tmp_path / "store/history/log").iterdir() if p.is_dir()}
        assert months == {"month=2024-05", "month=2024-06", "month=2024-07"}

    def test_log_and_state_change_together(self, spark, tmp_path, monkeypatch):
        land(tmp_path, "Revenue_Recognition", self.records(("1", 5, 1)))

        def dies(*args):
            raise OSError("lost")

        with monkeypatch.context() as patch:
            patch.setattr(Commits, "commit", dies)
            with pytest.raises(OSError):
                run(tmp_path, "modules", "r0", D1)
        history = History(Store(spark, str(tmp_path / "store")))
        assert history.read().count() == 0 and not history.state.exists()
        run(tmp_path, "modules", "r0", D1)  # repeated
        history = History(Store(spark, str(tmp_path / "store")))
        assert rows(history.read().select("revenue_id", "Type")) == [("1", "Create")]

    def test_a_log_of_the_earlier_layout_goes_on(self, spark, tmp_path):
        store = Store(spark, str(tmp_path / "store"))
        old = [("a0", "2024-01-01 00:00:00", None, "1", None, "d", "4", "Create"), ("a1", "2024-02-01 00:00:00", None, "1", None, "d", "5", "Amount changed"),
               ("a2", "2024-02-01 00:00:00", None, "9", None, "d", "1", "Create")]
        spark.createDataFrame(old, ", ".join(f"{c} string" for c in HISTORY_COLUMNS)).write.parquet(f"{store.root}/history/revenue_history")
        land(tmp_path, "Revenue_Recognition", self.records(("1", 5, 1), ("2", 6, 1)))
        run(tmp_path, "modules", "r0", D1)
        history = History(Store(spark, str(tmp_path / "store")))
        assert rows(history.read().select("revenue_id", "Type")) == sorted(
            [("1", "Create"), ("1", "Amount changed"), ("9", "Create"), ("2", "Create")], key=repr
        )
        assert rows(history.previous().select("id", "amount")) == [("1", "5"), ("2", "6"), ("9", "1")]


class TestObjects:
    def landing(self, path, deals):
        stages = [{"id": "s", "label": "S", "displayOrder": 0}]
        land(path, "pipelines", {"results": [{"id": "p", "label": "P", "stages": stages}]})
        land(path, "owners", {"results": [{"id": "1", "firstName": "A", "lastName": "B"}]})
        land(path, "owners_archived", {"results": []})
        land(path, "companies", {"results": [obj("c1", name="One", hs_lastmodifieddate=D1 + "Z")]})
        land(path, "line_items", {"results": [obj("l1", ["d1"], amount="1"), obj("l2", ["d1"], lastmodifieddate="soon")]})
        for deal in deals:
            land(path, "deals", deal)

    def test_without_all_companies(self, spark, tmp_path):
        self.landing(tmp_path, [{"results": [obj("d1", ["c1", "c2"], lastmodifieddate=D1 + "Z")]}])
        found = results(tmp_path, "objects", "r0", D2)
        assert [found[k].records for k in ("deals", "companies", "line_items")] == [1, 1, 2]
        assert rows(Store(spark, str(tmp_path / "store")).read("Companies").select("id")) == [("c1",)]

    def test_no_object_is_lost(self, spark, tmp_path):
        deals = [
            obj("1", lastmodifieddate="2024-05-01T00:00:00Z"),
            obj("2", hs_lastmodifieddate="2024-04-01T00:00:00Z"),
            obj("3", lastmodifieddate="soon"),
            obj("4"),
            obj("5", lastmodifieddate="1999-05-01T00:00:00Z", hs_lastmodifieddate="2024-04-01T00:00:00Z"),
        ]
        self.landing(tmp_path, [{"results": deals}])
        lines(tmp_path, "deals", "cut.json", '{"results": [{"id": "6"')
        lines(tmp_path, "line_items", "cut.json", *["garbage"] * 10)
        found = results(tmp_path, "objects", "r0", D2)
        assert (found["deals"].records, found["line_items"].records) == (5, 2)
        store = Store(spark, str(tmp_path / "store"))
        assert rows(store.read("Deals").select("id")) == [(k,) for k in "12345"]
        kept = store.quarantined().groupBy("table_name").count()
        assert rows(kept) == [("deals", 1), ("line_items", 10)]
        assert marks(spark, tmp_path)["deals"] == "2024-05-01"

    def test_more_bad_lines_than_the_budget_fail_the_run(self, spark, tmp_path):
        self.landing(tmp_path, [{"results": [obj("1")]}])
        lines(tmp_path, "line_items", "cut.json", *["garbage"] * 20)
        with pytest.raises(ValueError, match="unreadable"):
            run(tmp_path, "objects", "r0", D2)

    def test_a_cut_feed_goes_on(self, spark, tmp_path):
        first = {"results": [obj("1", lastmodifieddate="2024-05-01T00:00:00Z")], "paging": {"next": {"after": "x"}}}
        self.landing(tmp_path, [first])
        assert not results(tmp_path, "objects", "r0", D2)["deals"].complete and "deals" not in marks(spark, tmp_path)
        land(tmp_path, "deals", {"results": [obj("2", lastmodifieddate="2024-04-01T00:00:00Z")]})
        found = results(tmp_path, "objects", "r1", D3)
        assert found["deals"].complete and found["companies"].status == "idle"
        assert marks(spark, tmp_path)["deals"] == "2024-05-01"
        assert rows(Store(spark, str(tmp_path / "store")).read("Deals").select("id")) == [("1",), ("2",)]

    def test_the_mirror_of_all_companies_takes_new_files_only(self, spark, tmp_path):
        self.landing(tmp_path, [{"results": [obj("d1", ["c1", "c2"])]}])
        land(tmp_path, "all_companies", {"results": [obj(f"c{i}", name=f"n{i}") for i in (1, 2, 3)]})
        run(tmp_path, "objects", "r0", D2)
        land(tmp_path, "deals", {"results": [obj("d2", ["c3", "c4"])]})
        land(tmp_path, "all_companies", {"results": [obj("c4", name="n4")]})
        run(tmp_path, "objects", "r1", D3)
        store = Store(spark, str(tmp_path / "store"))
        assert rows(store.read("Companies").select("id", "name")) == [("c1", "One"), ("c2", "n2"), ("c3", "n3"), ("c4", "n4")]

    def test_a_cut_feed_of_pipelines_replaces_nothing(self, spark, tmp_path):
        self.landing(tmp_path, [{"results": [obj("1")]}])
        run(tmp_path, "refresh-objects", "r0", D1)
        stages = [{"id": "t", "label": "T", "displayOrder": 0}]
        (tmp_path / "landing/pipelines/part-0.json").write_text(
            json.dumps({"results": [{"id": "q", "label": "Q", "stages": stages}], "paging": {"next": {"after": "1"}}})
        )
        found = results(tmp_path, "refresh-objects", "r1", D2)
        assert found["pipelines"].status == "incomplete"
        assert rows(Store(spark, str(tmp_path / "store")).read("Pipelines").select("stage_id")) == [("s",)]


class TestLedger:
    def ledger(self, spark, path):
        return Arrivals(spark, f"{path}/landing", f"{path}/ledger", Commits(spark, f"{path}/commits"), "feed")

    def pages(self, spark, *items):
        return spark.createDataFrame([(p, m, 1, 0) for p, m in items], "page long, more boolean, records long, unreadable long")

    def write(self, path, name, text="x"):
        (path / "landing").mkdir(exist_ok=True)
        (path / "landing" / name).write_text(text)

    def test_files_are_new_until_they_are_committed(self, spark, tmp_path):
        assert self.ledger(spark, tmp_path).new_files() is None
        self.write(tmp_path, "a.json")
        ledger = self.ledger(spark, tmp_path)
        files = ledger.new_files()
        taken = ledger.take(files, self.pages(spark, (1, False)), "r0", 5)
        assert taken.complete and taken.observed == 5
        assert len(self.ledger(spark, tmp_path).new_files()) == 1  # not committed
        ledger.commits.commit("r0", taken.entries)
        assert self.ledger(spark, tmp_path).new_files() == []
        self.write(tmp_path, "a.json", "longer")
        self.write(tmp_path, "b.json")
        assert len(self.ledger(spark, tmp_path).new_files()) == 2

    def test_missing_pages_over_runs(self, spark, tmp_path):
        ledger = self.ledger(spark, tmp_path)
        want = [([(1, True), (4, False)], [2, 3], False), ([(3, True)], [2], False), ([(2, True)], [], True)]
        for k, (pages, missing, complete) in enumerate(want):
            taken = ledger.take([(f"f{k}", 1, utc(D1))], self.pages(spark, *pages), f"r{k}", k)
            ledger.commits.commit(f"r{k}", taken.entries)
            assert taken.complete is complete and taken.observed == max(0, k)
            if not complete:
                assert [r["page"] for r in ledger.missing_pages().orderBy("page").collect()] == missing
            assert ledger.is_open() is not complete

    @pytest.mark.parametrize(
        "pages, complete",
        [([], True), ([(1, False, 1)], True), ([(1, True, 1)], False), ([(2, False, 1)], False), ([(1, None, 1)], True),
         ([(1, True, 1), (1, False, 2)], True), ([(1, False, 1), (1, True, 2)], False), ([(None, True, 1)], False),
         ([(None, True, 1), (None, False, 1)], True)],
    )
    def test_end_of_a_fetch(self, spark, pages, complete):
        df = spark.createDataFrame(pages, "page long, more boolean, at long")
        assert reached_end(df).first()["complete"] is complete
