"""Target tables: columns, required columns, unique keys, foreign keys, value domains, defaults.

The names, types and constraints below are fixed values: they are the data contract of the target
schema. Geometry points are held as WKB plus an SRID column.
"""

from __future__ import annotations

from ..specs import ForeignKey, TableSpec, columns

ACTIVE = ("Active", "Inactive")
SYNC = ("Pending", "Processing", "Complete")
VISIT_TYPES = (
    "Farm Visit Full - ET", "Farm Visit Full - KE", "Farm Visit Full - PR", "Farm Visit Full - ZM",
    "Farm Visit", "Farm Visit Full", "Farm Visit Full - AI", "Farm Visit Full - BU",
)

STAMPS = "is_deleted boolean, deleted_at timestamp, created_at timestamp, updated_at timestamp, id string"
AUDIT = "created_by_id string, last_updated_by_id string"
STAMPS_REQUIRED = ("id", "is_deleted", "created_at", "updated_at")
AUDIT_REQUIRED = ("created_by_id", "last_updated_by_id")


def _table(
    name: str,
    ddl: str,
    required: str = "",
    unique: str = "",
    foreign: str = "",
    domains=None,
    defaults=None,
    source_id: bool = True,
    audit_required: bool = True,
) -> TableSpec:
    head = "from_sf boolean, sf_id string, " if source_id else ""
    schema = columns(f"{head}{STAMPS}, {ddl}, {AUDIT}")
    must = STAMPS_REQUIRED + (("from_sf",) if source_id else ())
    must += AUDIT_REQUIRED if audit_required else ()
    keys = tuple((k,) for k in unique.split())
    fks = tuple(ForeignKey(*pair.split(">")) for pair in foreign.split())
    base = {"is_deleted": False} | ({"from_sf": False} if source_id else {})
    return TableSpec(
        name, schema, must + tuple(required.split()), keys, fks, domains or {}, base | (defaults or {})
    )


USERS = _table(
    "users",
    "first_name string, middle_name string, last_name string, email string, user_role string, username string, "
    "password string, tns_id string, phone_number string, job_title string, commcare_mobile_worker_id string, "
    "manager_id string, status string",
    required="first_name last_name tns_id",
    unique="sf_id email username tns_id",
    foreign="manager_id>users",
    domains={"status": ACTIVE},
    audit_required=False,
)
PROGRAMS = _table(
    "programs", "program_name string, program_code string", "program_name program_code", "sf_id program_code"
)
LOCATIONS = _table(
    "locations",
    "location_name string, location_type string, parent_location_id string",
    required="location_name location_type",
    unique="sf_id",
    foreign="parent_location_id>locations",
)
PROJECTS = _table(
    "projects",
    "program_id string, project_name string, project_unique_id string, location_id string, start_date date, "
    "end_date date, status string",
    required="project_name project_unique_id status",
    unique="sf_id project_unique_id",
    foreign="program_id>programs location_id>locations",
    domains={"status": ACTIVE},
)
PROJECT_STAFF_ROLES = _table(
    "project_staff_roles",
    "project_id string, staff_id string, commcare_location_id string, commcare_case_id string, tns_id string, "
    "role string, send_to_commcare boolean, status string, send_to_commcare_status string",
    required="project_id staff_id commcare_case_id role send_to_commcare status send_to_commcare_status",
    unique="sf_id commcare_case_id",
    foreign="project_id>projects staff_id>users",
    domains={"status": ACTIVE, "send_to_commcare_status": SYNC},
    defaults={"send_to_commcare": False},
)
TRAINING_MODULES = _table(
    "training_modules",
    "project_id string, module_name string, module_number int, current_module boolean, "
    "sample_fv_aa_households boolean, sample_fv_aa_households_status string, status string, "
    "current_previous string, module_date date",
    required="status",
    unique="sf_id",
    foreign="project_id>projects",
    domains={"status": ACTIVE, "current_previous": ("Current", "Previous")},
)
FARMER_GROUPS = _table(
    "farmer_groups",
    "project_id string, responsible_staff_id string, tns_id string, commcare_case_id string, ffg_name string, "
    "send_to_commcare boolean, location_id string, fv_aa_sampling_round int, send_to_commcare_status string, "
    "status string",
    required="project_id responsible_staff_id tns_id commcare_case_id ffg_name send_to_commcare "
    "send_to_commcare_status status",
    unique="sf_id commcare_case_id",
    foreign="project_id>projects responsible_staff_id>users location_id>locations",
    domains={"status": ACTIVE, "send_to_commcare_status": SYNC},
)
TRAINING_SESSIONS = _table(
    "training_sessions",
    "trainer_id string, module_id string, farmer_group_id string, date_session_1 date, date_session_2 date, "
    "commcare_case_id string, male_attendees_session_1 int, female_attendees_session_1 int, "
    "total_attendees_session_1 int, male_attendees_session_2 int, female_attendees_session_2 int, "
    "total_attendees_session_2 int, male_attendees_agg int, female_attendees_agg int, total_attendees_agg int, "
    "location_gps_latitude_session_1 decimal(10,6), location_gps_longitude_session_1 decimal(10,6), "
    "location_gps_altitude_session_1 decimal(10,2), location_gps_latitude_session_2 decimal(10,6), "
    "location_gps_longitude_session_2 decimal(10,6), location_gps_altitude_session_2 decimal(10,2), "
    "send_to_commcare boolean, send_to_commcare_status string, sampled boolean, review_status string",
    required="module_id farmer_group_id commcare_case_id send_to_commcare send_to_commcare_status",
    unique="sf_id commcare_case_id",
    foreign="trainer_id>users module_id>training_modules farmer_group_id>farmer_groups",
    domains={"send_to_commcare_status": SYNC},
    defaults={"sampled": False},
)
IMAGES = _table(
    "images",
    "image_reference_type string, image_reference_id string, image_url string, verification_status string, "
    "submission_id string, image_description string",
    required="submission_id",
    unique="submission_id",
    source_id=False,
)
HOUSEHOLDS = _table(
    "households",
    "farmer_group_id string, household_name string, household_number int, tns_id string, commcare_case_id string, "
    "number_of_trees int, farm_size decimal(38,10), sampled_for_fv_aa boolean, farm_size_before decimal(10,6), "
    "farm_size_after decimal(10,6), farm_size_since decimal(10,6), visited_for_fv_aa boolean, "
    "fv_aa_sampling_round int, status string",
    required="farmer_group_id household_name household_number sampled_for_fv_aa visited_for_fv_aa "
    "fv_aa_sampling_round status",
    unique="sf_id commcare_case_id",
    foreign="farmer_group_id>farmer_groups",
    domains={"status": ACTIVE},
)
FARMERS = _table(
    "farmers",
    "household_id string, farmer_group_id string, tns_id string, commcare_case_id string, first_name string, "
    "middle_name string, last_name string, other_id string, age int, phone_number string, "
    "is_primary_household_member boolean, send_to_commcare boolean, status_notes string, status string, "
    "send_to_commcare_status string, gender string, farmer_status string",
    required="household_id farmer_group_id commcare_case_id first_name last_name age send_to_commcare status "
    "send_to_commcare_status gender",
    unique="sf_id commcare_case_id",
    foreign="household_id>households farmer_group_id>farmer_groups",
    domains={"status": ACTIVE, "send_to_commcare_status": SYNC, "gender": ("Male", "Female")},
)
ATTENDANCES = _table(
    "attendances",
    "farmer_id string, training_session_id string, date_attended date, submission_id string, status string",
    required="farmer_id training_session_id status",
    unique="sf_id submission_id",
    foreign="farmer_id>farmers training_session_id>training_sessions",
    domains={"status": ("Present", "Absent")},
)
OBSERVATIONS = _table(
    "observations",
    "submission_id string, observer_id string, trainer_id string, farmer_group_id string, "
    "training_session_id string, observation_date date, location_gps_latitude decimal(10,6), "
    "location_gps_longitude decimal(10,6), location_gps_altitude decimal(10,2), female_attendees int, "
    "male_attendees int, total_attendees int, comments string, observation_type string",
    required="observation_date",
    unique="sf_id",
    foreign="observer_id>users trainer_id>users farmer_group_id>farmer_groups "
    "training_session_id>training_sessions",
    domains={"observation_type": ("Training", "Demo Plot")},
)
# The submission id is the natural key: one source record yields several rows with its record id.
OBSERVATION_RESULTS = _table(
    "observation_results",
    "submission_id string, observation_id string, criterion string, question_key string, result_text string, "
    "result_numeric decimal(38,10), result_boolean boolean, result_url string",
    required="submission_id observation_id",
    unique="submission_id",
    foreign="observation_id>observations",
)
FARM_VISITS = _table(
    "farm_visits",
    "visited_household_id string, visited_primary_farmer_id string, visited_secondary_farmer_id string, "
    "submission_id string, training_session_id string, visiting_staff_id string, date_visited date, "
    "visit_comments string, latest_visit boolean, location_gps_latitude decimal(10,6), "
    "location_gps_longitude decimal(10,6), location_gps_altitude decimal(10,2), farm_visit_type string",
    required="submission_id visiting_staff_id date_visited latest_visit farm_visit_type",
    unique="sf_id submission_id",
    foreign="training_session_id>training_sessions visited_household_id>households "
    "visited_primary_farmer_id>farmers visited_secondary_farmer_id>farmers visiting_staff_id>users",
    domains={"farm_visit_type": VISIT_TYPES},
)
FV_BEST_PRACTICES = _table(
    "fv_best_practices",
    "submission_id string, farm_visit_id string, best_practice_type string, is_bp_verified boolean",
    required="submission_id farm_visit_id best_practice_type is_bp_verified",
    unique="sf_id submission_id",
    foreign="farm_visit_id>farm_visits",
)
FV_BEST_PRACTICE_ANSWERS = _table(
    "fv_best_practice_answers",
    "submission_id string, fv_best_practice_id string, question_key string, answer_text string, "
    "answer_numeric decimal(38,10), answer_boolean boolean, answer_url string",
    required="submission_id fv_best_practice_id question_key",
    unique="sf_id submission_id",
    foreign="fv_best_practice_id>fv_best_practices",
)
WETMILLS = _table(
    "wetmills",
    "user_id string, wet_mill_unique_id string, commcare_case_id string, name string, mill_status string, "
    "exporting_status string, programme string, country string, manager_name string, manager_role string, "
    "comments string, wetmill_counter int, ba_signature string, manager_signature string, "
    "tor_page_picture string, registration_date date, office_entrance_picture string, office_gps binary, "
    "office_gps_srid int",
    required="wet_mill_unique_id",
    unique="commcare_case_id",
    foreign="user_id>users",
    source_id=False,
)
WETMILL_VISITS = _table(
    "wetmill_visits",
    "wetmill_id string, user_id string, form_name string, visit_date date, entrance_photograph string, "
    "geo_location binary, geo_location_srid int, submission_id string",
    required="form_name visit_date submission_id",
    foreign="user_id>users wetmill_id>wetmills",
    source_id=False,
)
WV_SURVEY_RESPONSES = _table(
    "wv_survey_responses",
    "form_visit_id string, survey_type string, completed_date date, general_feedback string, submission_id string",
    required="form_visit_id survey_type submission_id",
    foreign="form_visit_id>wetmill_visits",
    source_id=False,
)
WV_SURVEY_QUESTION_RESPONSES = _table(
    "wv_survey_question_responses",
    "survey_response_id string, section_name string, question_name string, field_type string, "
    "submission_id string, value_text string, value_number double, value_boolean boolean, "
    "value_date timestamp_ntz, value_gps binary, value_gps_srid int",
    required="survey_response_id question_name field_type submission_id",
    foreign="survey_response_id>wv_survey_responses",
    source_id=False,
)

TABLES = {
    t.name: t
    for t in (
        USERS, PROGRAMS, LOCATIONS, PROJECTS, PROJECT_STAFF_ROLES, TRAINING_MODULES, FARMER_GROUPS,
        TRAINING_SESSIONS, IMAGES, HOUSEHOLDS, FARMERS, ATTENDANCES, OBSERVATIONS, OBSERVATION_RESULTS,
        FARM_VISITS, FV_BEST_PRACTICES, FV_BEST_PRACTICE_ANSWERS, WETMILLS, WETMILL_VISITS,
        WV_SURVEY_RESPONSES, WV_SURVEY_QUESTION_RESPONSES,
    )
}


def load_order(names=None) -> list[str]:
    """Tables so that every referenced table comes before the tables that refer to it."""
    wanted = list(names or TABLES)
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done or name not in wanted:
            return
        for fk in TABLES[name].foreign:
            if fk.table != name:
                visit(fk.table)
        done.append(name)

    for name in wanted:
        visit(name)
    return done
