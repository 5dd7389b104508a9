"""Loads of observations, observation results, farm visits and best-practice sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import (
    Hop, Rule, explode_groups, filter_by_parent,
    lookup_required, multi_emit, reject_if, require_all, route_rules, unpivot_fields,
)
from ..session import release
from ..specs import Lookup
from .extracts import ANSWER_FIELDS, IMAGE_FIELDS, OBSERVATION, PROJECT, QUESTION_KEYS, SHEET_FIELDS, TRAINING_GROUP
from .programme import _upsert, stamps
from .run import FrameRun, merge_spec, target_rows
from .tables import (
    FARM_VISITS, FV_BEST_PRACTICE_ANSWERS, FV_BEST_PRACTICES, IMAGES, OBSERVATION_RESULTS, OBSERVATIONS,
)

c = F.col


def observations(run: FrameRun):
    df = run.extract("observations")
    df = lookup_required(
        df,
        [
            Lookup("Observer__c", run.ids("users"), "observer_id", required=True),
            Lookup("Trainer__c", run.ids("users"), "trainer_id"),
            Lookup("Training_Group__c", run.ids("farmer_groups"), "farmer_group_id", required=True),
            Lookup("Training_Session__c", run.ids("training_sessions"), "training_session_id"),
        ],
    )
    df = (
        df.withColumn("_lat", X.to_double(c("Observation_Location__Latitude__s")))
        .withColumn("_lng", X.to_double(c("Observation_Location__Longitude__s")))
        .withColumn("_alt", X.to_double(c("Altitude__c")))
    )
    df = require_all(df, ["Id", "_lat", "_lng", "_alt", "Date__c", "Submission_ID__c"], falsy=run.cfg.reject_zero)
    mapping = stamps() | {
        "submission_id": "Submission_ID__c",
        "observer_id": "observer_id",
        "trainer_id": "trainer_id",
        "farmer_group_id": "farmer_group_id",
        "training_session_id": "training_session_id",
        "observation_date": "Date__c",
        "location_gps_latitude": "_lat",
        "location_gps_longitude": "_lng",
        "location_gps_altitude": "_alt",
        "female_attendees": X.to_int(c("Female_Participants__c")),
        "male_attendees": X.to_int(c("Male_Participants__c")),
        "total_attendees": X.to_int(c("Number_of_Participants__c")),
        "comments": X.join_nonempty("\n", c("Comments_1__c"), c("Comments_2__c"), c("Comments_3__c")),
        "observation_type": X.kind_by_substring(c("RecordType.Name"), "demo", "Demo Plot", "Training"),
    }
    return _upsert(run, OBSERVATIONS, df, mapping, {"created_at": "target"})


# The decision table of observation results. Per rule: record type, value kind,
# accepted criteria, criterion label, question key, literal replacements, and whether the last
# character of the submission id becomes part of the key. First match wins.
FEEDBACK, TRAINING, DEMO = "Participant Feedback", "Training Observation", "Demo Plot Observation"
ORDINALS = {"p1": "Participant_One_Feedback", "p2": "Participant_Two_Feedback", "p3": "Participant_Three_Feedback"}
BLANKS = ("_", " ")
DEMO_RULES = (
    ("result", ("Compost Heap",), "Compost Heap", "present_compost_heap", (BLANKS, ("Yes compost", "Yes, compost")), False),
    ("result", ("Mulch", "Mulching"), "Mulch", "mulch_under_the_canopy", (BLANKS, ("Yes Some", "Yes, Some")), False),
    ("result", ("Shade Management",), "Shade Management", "level_of_shade_present", (BLANKS,), False),
    ("result", ("Vetiver Planted",), "Vetiver Planted", "vetiver_planted",
     (BLANKS, ("Yes Row", "Yes. Row"), ("No Vetiver", "No. Vetiver")), False),
    ("result", ("Weed Management",), "Weed Management", "has_the_demo_plot_been_dug",
     (BLANKS, ("Yes field", "Yes, field")), False),
    ("result", ("Rejuvenation",), "Rejuvenation", "rejuvenation_plot", (), False),
    ("result", ("Sucker Selection",), "Sucker Selection", "Sucker_Selection_Taken_Place",
     (BLANKS, ("No Many", "No, Many"), ("Yes Sucker", "Yes. Sucker"),
      ("No. Sucker selection has not been done", "No, Many suckers"), ("is complete", "completed")), False),
    ("result", ("Stumped Trees",), "Stumped Trees", "stumped_trees", (BLANKS, ("Yes demo", "Yes, demo")), False),
    ("result", ("Pruning",), "Pruning", "pruning_methods", (), True),
    ("result", ("Covercrop",), "Covercrop Planted", "covercrop_present", (), True),
    ("number", None, "Sucker Selection", "number_of_suckers", (), False),
    ("text", ("Mulch", "Mulching"), "Mulch", "thickness_of_mulch", (BLANKS, ("mulch.", "mulch")), False),
    # The shade trees answer is filed under Mulch on purpose: stored data has it there.
    ("text", ("Shade Management",), "Mulch", "shade_trees_planted", (), False),
    ("text", ("Weed Management",), "Weed Management", "how_big_are_the_weeds", (), False),
    ("text", ("Rejuvenation",), "Rejuvenation", "suckers_three", (), False),
    ("text_two", ("Weed Management",), "Weed Management", "how_many_weeds_are_under_the_tree_canopy", (BLANKS,), False),
    ("text_two", ("Shade Management",), "Shade Management", "banana_intercrop", (), False),
)


def _main_id():
    return X.key_slice(c("submission"), head=36)


def _feedback(kind: str, key) -> Rule:
    def out():
        entries = [F.lit(x) for pair in ORDINALS.items() for x in pair]
        who = F.try_element_at(F.create_map(*entries), X.key_slice(c("submission"), tail=2))
        # A submission id without a known participant ending keeps the text None in its key.
        label = F.concat(F.coalesce(who, F.lit("None")), F.lit("_"), key())
        return {"criterion_out": F.lit(FEEDBACK), "question_key": key(), "result_text": c("value"),
                "submission_id": X.composite_key("-", _main_id(), label)}

    return Rule(f"feedback_{kind}", {"record_type": [FEEDBACK], "kind": [kind]}, out)


def _training(kind: str, suffix: str) -> Rule:
    def out():
        key = F.concat(F.replace(c("criterion"), F.lit(" "), F.lit("_")), F.lit(suffix))
        return {"criterion_out": F.lit("Observer Feedback"), "question_key": key, "result_text": c("value"),
                "submission_id": X.composite_key("-", _main_id(), key)}

    return Rule(f"training_{kind}", {"record_type": [TRAINING], "kind": [kind]}, out)


def _demo(kind, accepted, label, key, pairs, numbered) -> Rule:
    def out():
        parts = [_main_id(), F.lit(key)] + ([X.key_slice(c("submission"), tail=1)] if numbered else [])
        made = {"criterion_out": F.lit(label), "question_key": F.lit(key), "submission_id": X.composite_key("-", *parts)}
        if kind == "number":
            return made | {"result_numeric": X.to_int(c("value"))}
        return made | {"result_text": X.replace_chain(c("value"), pairs)}

    when = {"record_type": [DEMO], "kind": [kind]} | ({"criterion": list(accepted)} if accepted else {})
    return Rule(f"demo_{key}", when, out)


def result_rules() -> list[Rule]:
    return [
        _feedback("result", lambda: X.title_key(c("criterion"))),
        _feedback("comments", lambda: F.lit("participant_comments")),
        _feedback("sex", lambda: F.lit("Participant_Gender")),
        _training("result", ""),
        *[_demo(*row) for row in DEMO_RULES],
        _training("comments", "_Comments"),
    ]


def emitted_results(df):
    """Up to six rows per record: one per value it holds; the number only next to a result."""
    filled = lambda name: F.coalesce(c(name) != "", F.lit(False))
    some = filled("Result_Number__c") & (F.coalesce(X.to_double(c("Result_Number__c")), F.lit(1.0)) != 0)
    emits = [
        ("result", c("Result__c"), filled("Result__c")),
        ("sex", c("Participant_Sex__c"), filled("Participant_Sex__c")),
        ("comments", c("Comments__c"), filled("Comments__c")),
        ("number", c("Result_Number__c"), some & filled("Result__c")),
        ("text", c("Result_Text__c"), filled("Result_Text__c")),
        ("text_two", c("Result_Text_Two__c"), filled("Result_Text_Two__c")),
    ]
    flat = df.withColumn("record_type", c("RecordType.Name")).withColumn("criterion", c("Observation_Criterion__r.Name"))
    flat = flat.withColumnRenamed("Submission_ID__c", "submission")
    carry = ["Id", "IsDeleted", "CreatedDate", "LastModifiedDate", "submission", "Observation__c", "record_type", "criterion"]
    return multi_emit(flat, emits, carry)


def observation_results(run: FrameRun):
    """Results of active projects, fanned out, routed, newest per key, updated only when changed."""
    hops = [
        Hop("Observation__c", run.extract("observations", OBSERVATION), "Id"),
        Hop("Training_Group__c", run.extract("farmer_groups", TRAINING_GROUP), "Id"),
        Hop("Project__c", run.extract("projects", PROJECT), "Id"),
    ]
    src = filter_by_parent(run.extract("observation_results"), hops, c("Project_Status__c") == "Active")
    outputs = {"criterion_out": "string", "question_key": "string", "result_text": "string",
               "result_numeric": "bigint", "submission_id": "string"}
    df = route_rules(emitted_results(src), result_rules(), outputs)
    df = reject_if(df, c("submission_id").isNull(), "unrouted")
    # the filter has brought the records together by their observation
    df = lookup_required(df, [Lookup("Observation__c", run.ids("observations"), "observation_id", required=True, filled=True)])
    mapping = stamps() | {
        "submission_id": "submission_id",
        "observation_id": "observation_id",
        "criterion": "criterion_out",
        "question_key": "question_key",
        "result_text": "result_text",
        "result_numeric": "result_numeric",
        "result_boolean": F.lit(None).cast("boolean"),
        "result_url": F.lit(None).cast("string"),
    }
    rows = target_rows(df, OBSERVATION_RESULTS, run.cfg, mapping, c("submission_id"))
    rules = {"created_at": "target"}
    spec = merge_spec(("submission_id",), rows, OBSERVATION_RESULTS, mapping, rules, changed="updated_at")
    return run.load(OBSERVATION_RESULTS, rows, spec)


def farm_visits(run: FrameRun):
    farmers = run.ids("farmers")
    df = lookup_required(
        run.extract("farm_visits"),
        [
            Lookup("Household__c", run.ids("households"), "visited_household_id"),
            Lookup("Farm_Visited__c", farmers, "visited_primary_farmer_id"),
            Lookup("Secondary_Farmer__c", farmers, "visited_secondary_farmer_id"),
            Lookup("Training_Session__c", run.ids("training_sessions"), "training_session_id"),
            Lookup("Farmer_Trainer__c", run.ids("users"), "visiting_staff_id"),
        ],
    )
    mapping = stamps() | {
        "visited_household_id": "visited_household_id",
        "visited_primary_farmer_id": "visited_primary_farmer_id",
        "visited_secondary_farmer_id": "visited_secondary_farmer_id",
        "training_session_id": "training_session_id",
        "visiting_staff_id": "visiting_staff_id",
        "submission_id": X.first_truthy(c("FV_Submission_ID__c"), c("Id")),
        "date_visited": "Date_Visited__c",
        "visit_comments": "visit_comments__c",
        "latest_visit": X.to_bool3(c("Latest_Visit__c"), True),
        "location_gps_latitude": X.to_double(c("Location_GPS__Latitude__s")),
        "location_gps_longitude": X.to_double(c("Location_GPS__Longitude__s")),
        "location_gps_altitude": X.to_double(c("Altitude__c")),
        "farm_visit_type": X.first_truthy(c("Farm_Visit_Type__c"), F.lit("Farm Visit")),
    }
    # Records of one submission apply in the order they were created.
    df = df.withColumn("_created", X.to_ts_utc(c("CreatedDate")))
    return _upsert(run, FARM_VISITS, df, mapping, key=("submission_id",), order=("_created", "updated_at"), carry=("_created",))


SLICE_MB, MOST_SLICES = 256, 6  # of sheets whose lookups are computed at a time


def _slices(sheets: DataFrame) -> int:
    """In how many slices the sheets meet what they refer to, by their size as Spark knows it."""
    size = int(str(sheets._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(MOST_SLICES, 1 + size // (SLICE_MB << 20))


def _slice(df: DataFrame, key: Column, k: int, n: int) -> DataFrame:
    """Rows of the k-th of n slices by the hash of a key; null keys are in one of them, too."""
    return df if n == 1 else df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == k)


def fv_best_practices(run: FrameRun):
    """One wide sheet becomes headers, typed answers and images.

    Headers are merged first; answers and images then resolve their header in the merged table.
    The sheets apply newest first, so of two sheets for one key the older one has the last word.

    Lookups take the sheets slice by slice, together with the keys they can meet, so the shuffles of one slice are on disk at a time.
    """
    # read and cleaned once; the three outputs take their columns from the written copy
    src = run.stage("fv_best_practices_sheets", run.extract("fv_best_practices"))
    carry = ["Farm_Visit__c", "IsDeleted", "CreatedDate", "LastModifiedDate"]
    ids = ("Id", "FV_Submission_ID__c")
    shared = {k: v for k, v in stamps().items() if k != "sf_id"}
    newest_first = ("_back",)
    back = (-F.unix_micros(X.to_ts_utc(c("CreatedDate")))).alias("_back")
    made = lambda table, key: {"id": X.stable_id(F.lit(table.name), c(key)), "_back": -F.unix_micros("created_at")}
    n = _slices(src)

    visits = run.ids("farm_visits")
    mapping = shared | {
        "sf_id": "header_id",
        "submission_id": "header_alt_id",
        "farm_visit_id": "farm_visit_id",
        "best_practice_type": "best_practice_type",
        "is_bp_verified": F.lit(False),
    }
    rows = []
    for k in range(n):
        heads = explode_groups(_slice(src, c("Farm_Visit__c"), k, n), SHEET_FIELDS, *ids, carry, "best_practice_type").select("*", back)
        heads = lookup_required(heads, [Lookup("Farm_Visit__c", _slice(visits, c("sf_id"), k, n), "farm_visit_id", required=True)])
        rows.append(target_rows(heads, FV_BEST_PRACTICES, run.cfg, mapping, c("header_id"), newest_first))
    spec = merge_spec(("sf_id",), rows[0], FV_BEST_PRACTICES, mapping, order=newest_first)
    run.load(FV_BEST_PRACTICES, rows, spec, guard=("sf_id", "submission_id"), made=made(FV_BEST_PRACTICES, "sf_id"))

    headers = run.ids("fv_best_practices")
    # a header's key is that of its sheet and a group, in whose name there is no colon
    sheet = F.expr("left(sf_id, length(sf_id) - length(substring_index(sf_id, ':', -1)) - 1)")
    owners = [Lookup("header_id", _slice(headers, sheet, k, n), "fv_best_practice_id", required=True) for k in range(n)]
    mapping = shared | {
        "sf_id": "row_id",
        "submission_id": "row_alt_id",
        "fv_best_practice_id": "fv_best_practice_id",
        "question_key": "question_key",
        **{f"answer_{k}": c(f"_v.{k}") for k in ("text", "numeric", "boolean", "url")},
    }
    rows = []
    for k, owner in enumerate(owners):
        cells = unpivot_fields(_slice(src, c("Id"), k, n), ANSWER_FIELDS, *ids, QUESTION_KEYS, lambda f: f.removesuffix("__c"), carry).select("*", back)
        cells = lookup_required(cells, [owner]).withColumn("_v", X.typed_value(c("raw_value")))
        rows.append(target_rows(cells, FV_BEST_PRACTICE_ANSWERS, run.cfg, mapping, c("row_id"), newest_first))
    spec = merge_spec(("sf_id",), rows[0], FV_BEST_PRACTICE_ANSWERS, mapping, order=newest_first)
    run.load(FV_BEST_PRACTICE_ANSWERS, rows, spec, made=made(FV_BEST_PRACTICE_ANSWERS, "sf_id"))

    mapping = shared | {
        "image_reference_type": F.lit("fv_best_practice"),
        "image_reference_id": "fv_best_practice_id",
        "image_url": "raw_value",
        "submission_id": "row_alt_id",
        "image_description": "field",
        "verification_status": F.lit(None).cast("string"),
    }
    rows = []
    for k, owner in enumerate(owners):
        photos = unpivot_fields(_slice(src, c("Id"), k, n), IMAGE_FIELDS, *ids, carry=carry).select("*", back)
        photos = lookup_required(photos, [owner])
        rows.append(target_rows(photos, IMAGES, run.cfg, mapping, c("row_alt_id"), newest_first))
    spec = merge_spec(("submission_id",), rows[0], IMAGES, mapping, {"created_at": "target"}, newest_first)
    images = run.load(IMAGES, rows, spec, made=made(IMAGES, "submission_id"))
    release(src)  # all rows are written
    return images
