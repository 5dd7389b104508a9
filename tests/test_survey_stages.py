"""Wet-mill surveys write each file's rows once."""

from pyspark.sql import functions as F

from sample_extracts import SURVEYS
from keyferry.plans import STEPS, FrameRun, LoadConfig
from keyferry.plans.surveys import _own_id
from keyferry.plans.tables import WETMILLS


def test_an_id_of_several_rows_goes_to_the_first(quick):
    data = [("a", "c1", "2024-01-02"), ("a", "c2", "2024-01-01"), ("b", "c3", "2024-01-01"), (None, "c4", "2024-01-01")]
    df = quick.createDataFrame(data, "id string, commcare_case_id string, updated_at string")
    run = FrameRun(quick, LoadConfig("sys"), {})
    got = {r["commcare_case_id"]: r["_id"] for r in _own_id(run, df, WETMILLS, F.concat(F.lit("0:"), F.col("commcare_case_id"))).collect()}
    assert got["c2"] == "a" and got["c3"] == "b"
    assert got["c1"] not in ("a", None) and got["c4"] is not None


def test_surveys_write_the_rows_of_each_file_once(quick, monkeypatch):
    frames = {n: quick.createDataFrame([tuple(r) for r in rows], ", ".join(f"{h} string" for h in head)) for n, (head, rows) in SURVEYS.items()}
    frames["legacy_users"] = quick.createDataFrame([("acc-2", "U2", "a@x.test")], "user_id string, sf_user_id string, user_email string")
    written, keep = [], FrameRun.stage
    monkeypatch.setattr(FrameRun, "stage", lambda self, name, df: written.append(name) or keep(self, name, df))
    run = FrameRun(quick, LoadConfig("sys"), frames)
    STEPS["wetmills"].load(run)
    assert written == ["wetmills_rows", "wetmill_visits_rows", "wv_survey_responses_rows", "wv_survey_question_responses_rows"]
    assert {r["id"]: r["wetmill_id"] for r in run.target("wetmill_visits").collect()} == {"v-1": "w-1", "v-2": "w-1"}
    assert {r["id"] for r in run.target("wv_survey_question_responses").collect()} == {"q-1", "q-2"}
