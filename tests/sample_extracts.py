"""Synthetic landed files for every load. All persons, places and ids are invented."""

from __future__ import annotations

import csv
import json
import os

from keyferry.plans.extracts import LEGACY_FILES, SOURCES, SURVEY_FILES

OLD, NEW = "2024-01-01T10:00:00.000+0000", "2024-03-01T10:00:00.000+0000"
POINT = "0101000020E6100000000000000000F03F0000000000000040"


def rec(i, updated=NEW, deleted=False, **fields):
    return {"attributes": {"type": "x"}, "Id": i, "IsDeleted": deleted, "CreatedDate": OLD, "LastModifiedDate": updated, **fields}


OBJECTS = {
    "users": [
        rec("U1", FirstName="Ada", LastName="Fen", Email="Ada@Mail.test ", TNS_Id__c="T1", contact_status__c="Active"),
        rec("U2", FirstName="Ben", LastName="Oak", Email="ada@mail.test", TNS_Id__c="T2", contact_status__c="Active"),
        rec("U3", FirstName="Cy", LastName="Elm", Email="broken", TNS_Id__c="", contact_status__c="Inactive"),
        rec("U4", FirstName="Di", LastName="Ash", TNS_Id__c="T4"),
        rec("U5", FirstName=None, LastName="Yew", Email="y@mail.test", TNS_Id__c="T5"),
        rec("U6", updated="2024-03-02T10:00:00.000+0000", FirstName="Flo", LastName="Bay", Email="flo@mail.test", TNS_Id__c="T1"),
        rec("U7", deleted=True, FirstName="Gus", LastName="Fir", Email="gus@mail.test", TNS_Id__c="T7"),
    ],
    "programs": [rec("P1", Name="North"), rec("P1", updated="2024-04-01T10:00:00.000+0000", Name="North 2"), rec("P2", Name="South")],
    "locations": [
        rec("L1", Name="Land", Type__c="Country"),
        rec("L2", Name="Town", Parent_Location__c="L1"),
        rec("L3", Name="Lost", Type__c="", Parent_Location__c="L9"),
        rec("L4", deleted=True, Name="Gone"),
    ],
    "projects": [
        rec("J1", Name="One", Project_Unique_Id__c="one", Project_Status__c="Active", Project_Start_Date__c="2023-05-06", Program__c="P1", Project_Country__c="L1"),
        rec("J2", Name="Two", Project_Status__c="Inactive", Program__c="P9"),
        rec("J3", Name="Bad", Project_Status__c="Paused"),
    ],
    "project_staff_roles": [
        rec("R1", Project__c="J1", Staff__c="U1", Role__c="Trainer", Roles_Status__c="Active", CommCare_Case_Id__c="c1", Create_In_CommCare__c=True, Project_Location__c="PL1"),
        rec("R2", Project__c="J1", Staff__c="U2", Roles_Status__c="Active", CommCare_Case_Id__c="c2", Project_Location__c="PL9"),
        rec("R3", Project__c="J1", Staff__c="U1", Roles_Status__c="Active", CommCare_Case_Id__c="c3", Project_Location__c=""),
        rec("R4", Project__c="J1", Staff__c="U9", Roles_Status__c="Active", CommCare_Case_Id__c="c4", Project_Location__c="PL1"),
    ],
    "worker_groups": [{"Location_Id__c": "PL1", "CC_Mobile_Worker_Group_Id__c": "wg1"}],
    "training_modules": [
        rec("M1", Name="m", Module_Title__c="Weeds", Module_Number__c=3.0, Project__c="J1", Current_Training_Module__c=True, Current_Previous_Module__c="Current"),
        rec("M2", Name="fallback", Module_Title__c="", Module_Number__c="x", Project__c="J9"),
    ],
    "farmer_groups": [
        rec("G1", Name="Group", Project__c="J1", Responsible_Staff__c="U1", TNS_Id__c="g1", CommCare_Case_Id__c="gc1", FV_AA_Current_Sampling_Round__c="2", Location__c="L2"),
        rec("G2", Name="", Project__c="J2", Responsible_Staff__c="U2"),
        rec("G3", Name="NoStaff", Project__c="J1", Responsible_Staff__c="U9"),
    ],
    "training_sessions": [
        rec("S1", Training_Group__c="G1", Training_Module__c="M1", Trainer__c="U1", Date__c="2024-02-02", Male_Attendance__c="12.9", Female_Attendance__c=3,
            Second_Male_Attendance__c="4", Male_Count_Light_Full__c=0, Female_Count_Light_Full__c=7, Location_GPS__Latitude__s="1.23456789", Altitude__c="abc",
            Session_Photo_URL__c="http://p/1", Session_Photo_URL_2__c="http://p/2"),
        rec("S2", Training_Group__c="G1", Training_Module__c="M9", Session_Photo_URL__c=None, Session_Photo_URL_2__c=""),
        rec("S3", Training_Group__c="G2", Training_Module__c="M2", Trainer__c="U9", CommCare_Case_Id__c="sc3", Location_GPS__Latitude__s="123456.5"),
    ],
    "households": [
        rec("H1", Name="12", Training_Group__c="G1", Household_ID__c="h1", Household_Number__c=0, Farm_Size__c="1.5", Coffee_Seedlings__c="30.7"),
        rec("H2", Name="Home", Training_Group__c="G1", Household_ID__c="h2"),
        rec("H3", Name="7", Training_Group__c="G9", Household_ID__c="h3"),
        rec("H4", Name="8", Training_Group__c="G2", Household_ID__c=None),
        rec("H5", Name="9", Training_Group__c="G2", Household_ID__c="h5", Household_Number__c="21"),
    ],
    "farmers": [
        rec("F1", Name="Ann", Last_Name__c="Roe", Training_Group__c="G1", Household__c="H1", TNS_Id__c="f1", CommCare_Case_Id__c="fc1", Gender__c="female", Age__c="33.0", Primary_Household_Member__c="Yes"),
        rec("F2", Name="", Training_Group__c="G1", Household__c="H1", CommCare_Case_Id__c="fc2", Gender__c="?", Extra_No__c="n2"),
        rec("F3", Name="Dup", Training_Group__c="G1", Household__c="H5", TNS_Id__c="f3", CommCare_Case_Id__c="fc1"),
        rec("F4", Name="NoHouse", Training_Group__c="G1", Household__c="H9", TNS_Id__c="f4"),
    ],
    "attendances": [
        rec("A1", Participant__c="F1", Training_Session__c="S1", Date__c="2024-02-02", Status__c=" present", Submission_ID__c="as1"),
        rec("A2", Participant__c="F2", Training_Session__c="S1", Status__c="", Attended__c="1.0", Submission_ID__c=None),
        rec("A3", Participant__c="F9", Training_Session__c="S1", Submission_ID__c="as3"),
        rec("A4", updated="2024-05-01T10:00:00.000+0000", Participant__c="F2", Training_Session__c="S1", Status__c="no", Submission_ID__c="as1"),
    ],
    "observations": [
        rec("O1", Submission_ID__c="os1", Date__c="2024-02-03", Observer__c="U1", Trainer__c="U2", Training_Group__c="G1", Training_Session__c="S1",
            Female_Participants__c="5", Observation_Location__Latitude__s="1.5", Observation_Location__Longitude__s="2.5", Altitude__c="900",
            RecordType={"Name": "Demo Plot Observation"}, Comments_1__c="a", Comments_2__c="", Comments_3__c=" c "),
        rec("O2", Submission_ID__c="os2", Date__c="2024-02-03", Observer__c="U1", Training_Group__c="G1", Observation_Location__Latitude__s="0",
            Observation_Location__Longitude__s="2.5", Altitude__c="900", RecordType=None),
        rec("O3", Submission_ID__c="os3", Date__c="2024-02-03", Observer__c="U1", Training_Group__c="G2", Observation_Location__Latitude__s="1",
            Observation_Location__Longitude__s="2", Altitude__c="3", RecordType={"Name": "Training Observation"}),
    ],
    "observation_results": [
        rec("X1", Submission_ID__c="0123456789abcdef0123456789abcdef0123-x-p1", Observation__c="O1", Observation_Criterion__r={"Name": "clear voice"},
            RecordType={"Name": "Participant Feedback"}, Result__c="good", Participant_Sex__c="F", Comments__c="nice"),
        rec("X2", Submission_ID__c="1123456789abcdef0123456789abcdef0123-7", Observation__c="O1", Observation_Criterion__r={"Name": "Sucker Selection"},
            RecordType={"Name": "Demo Plot Observation"}, Result__c="Yes_Sucker selection is complete", Result_Number__c=4, Result_Text__c="t", Comments__c="c"),
        rec("X3", Submission_ID__c="2123456789abcdef0123456789abcdef0123-7", Observation__c="O1", Observation_Criterion__r={"Name": "Pruning"},
            RecordType={"Name": "Demo Plot Observation"}, Result__c="cut"),
        rec("X4", Submission_ID__c="3123456789abcdef0123456789abcdef0123-7", Observation__c="O1", Observation_Criterion__r=None, RecordType=None, Result__c="?"),
        rec("X5", Submission_ID__c="4123456789abcdef0123456789abcdef0123-7", Observation__c="O3", Observation_Criterion__r={"Name": "Mulch"},
            RecordType={"Name": "Demo Plot Observation"}, Result__c="inactive project"),
        rec("X6", updated="2024-06-01T10:00:00.000+0000", Submission_ID__c="2123456789abcdef0123456789abcdef0123-7", Observation__c="O1",
            Observation_Criterion__r={"Name": "Pruning"}, RecordType={"Name": "Demo Plot Observation"}, Result__c="newer"),
    ],
    "farm_visits": [
        rec("V1", Date_Visited__c="2024-02-05", Farm_Visit_Type__c="Farm Visit Full", Household__c="H1", Farm_Visited__c="F1", Secondary_Farmer__c="F2",
            Training_Session__c="S1", Farmer_Trainer__c="U1", FV_Submission_ID__c="vs1", Latest_Visit__c="no", Altitude__c="12.345"),
        rec("V2", Date_Visited__c="2024-02-06", Household__c="H9", Farmer_Trainer__c="U2"),
        rec("V3", Date_Visited__c="2024-02-06", Farmer_Trainer__c="U9"),
        rec("V4", Date_Visited__c="2024-02-06", Farm_Visit_Type__c="Picnic", Farmer_Trainer__c="U1"),
    ],
    "fv_best_practices": [
        rec("B1", Farm_Visit__c="V1", FV_Submission_ID__c="bs1", Do_you_have_compost_manure__c="1", photo_of_the_compost_manure__c=" http://i/1 ",
            number_of_trees_stumped__c="17", year_stumping__c="https://x/y", stumping_method_on_majority_of_trees__c="  side  "),
        rec("B2", Farm_Visit__c="V2", FV_Submission_ID__c="bs2", is_there_a_kitchen_garden__c=" "),
        rec("B3", Farm_Visit__c="V9", FV_Submission_ID__c="bs3", used_pesticide__c="no"),
        rec("B4", Farm_Visit__c="V2", FV_Submission_ID__c=None, photograph_of_kitchen_garden__c="http://i/4"),
    ],
}

CSVS = {
    "users": (
        "user_id user_name user_email mobile_no role_id account_status createdAt updatedAt sf_user_id".split(),
        [
            ["acc-1", "Ada B Fen", "ADA@mail.test", "NULL", "r1", "active", "2023-11-28 15:08:22.577582+02", "2023-11-28 15:08:22.577582+02", "NULL"],
            ["acc-2", "Zed", "zed@mail.test", "55", "r2", "disabled", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02", "SF-Z"],
            ["acc-3", "Zed Again", "zed@mail.test", "", "r9", "0", "2023-11-29 15:08:22+02", "2023-11-29 15:08:22+02", ""],
            ["acc-4", "", "", "", "r3", "", "2023-11-30 00:00:00+02", "2023-11-30 00:00:00+02", "null"],
        ],
    ),
    "roles": (
        "role_id role_name role_desc".split(),
        [["r1", "farmer_trainer", "d"], ["r2", "super_admin", "d"], ["r3", "gardener", "two\nlines"]],
    ),
    "project_roles": (
        "pr_id user_id project_id role createdAt updatedAt".split(),
        [
            ["pr-1", "acc-1", "old-1", "r1", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
            ["pr-2", "acc-1", "old-1", "r1", "2023-11-29 15:08:22+02", "2023-11-29 15:08:22+02"],
            ["pr-3", "acc-2", "old-1", "r2", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
            ["pr-4", "acc-2", "old-9", "r1", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
            ["pr-5", "acc-2", "old-2", "r1", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
            ["pr-6", "acc-2", "old-1", "r3", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
            ["pr-7", "acc-2", "old-1", "r8", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
            ["pr-8", "ghost", "old-1", "r1", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
            ["pr-9", "acc-3", "old-1", "r1", "2023-11-28 15:08:22+02", "2023-11-28 15:08:22+02"],
        ],
    ),
    "old_projects": ("project_id sf_project_id project_name".split(), [["old-1", "J1", "One"], ["old-2", "J9", "Nine"]]),
}
SURVEYS = {
    "wetmills": (
        "id user_id wet_mill_unique_id commcare_case_id name wetmill_counter registration_date office_gps is_deleted created_at updated_at "
        "mill_status exporting_status programme country manager_name manager_role comments ba_signature manager_signature tor_page_picture "
        "office_entrance_picture".split(),
        [
            ["w-1", "acc-2", "wm1", "wc1", "Mill", "3.0", "2024-01-02", POINT, "False", "2024-01-02 00:00:00+00", "2024-01-02 00:00:00+00"] + [""] * 11,
            ["w-2", "nobody", "wm2", "wc1", "Mill again", "x", "bad", "", "True", "2024-01-03 00:00:00+00", "2024-01-03 00:00:00+00"] + [""] * 11,
            ["w-3", "", "wm3", "", "No case", "", "", "zz", "False", "2024-01-03 00:00:00+00", "2024-01-03 00:00:00+00"] + [""] * 11,
            ["w-4", "U-x", "wm4", "NULL", "No case 4", "", "", "", "t", "2024-01-03 00:00:00+00", "2024-01-03 00:00:00+00"] + [""] * 11,
        ],
    ),
    "wetmill_visits": (
        "id wetmill_id user_id form_name visit_date entrance_photograph geo_location submission_id mill_external_id created_at updated_at".split(),
        [
            ["v-1", "w-1", "acc-2", "form", "2024-02-01", "", POINT, "sub-1", "", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
            ["v-2", "w-2", "acc-2", "form", "2024-02-02", "", "", "sub-2", "", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
            ["v-3", "w-9", "acc-2", "form", "2024-02-02", "", "", "sub-3", "", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
        ],
    ),
    "survey_responses": (
        "id form_visit_id survey_type completed_date general_feedback submission_id created_at updated_at".split(),
        [
            ["s-1", "v-1", "cpqi", "2024-02-01", "none", "ss-1", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
            ["s-2", "v-3", "cpqi", "2024-02-01", "ok", "ss-2", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
        ],
    ),
    "survey_question_responses": (
        "id survey_response_id section_name question_name field_type value_text value_number value_boolean value_date value_gps submission_id created_at updated_at".split(),
        [
            ["q-1", "s-1", "sec", "q1", "number", "", "4.5", "", "", "", "qs-1", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
            ["q-2", "s-1", "sec", "q2", "bool", "", "", "False", "2024-02-01 10:00:00+02", POINT, "qs-2", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
            ["q-3", "s-2", "sec", "q3", "text", "x", "", "", "", "", "qs-3", "2024-02-01 00:00:00+00", "2024-02-01 00:00:00+00"],
        ],
    ),
}


def land(root: str) -> str:
    """Write every extract below ``root``: JSON lines per object, CSV files beside them."""
    merged: dict[str, dict[str, dict]] = {}
    for name, rows in OBJECTS.items():
        merged.setdefault(SOURCES[name].name, {})
        for i, row in enumerate(rows):
            merged[SOURCES[name].name][f"{row.get('Id')}-{i}"] = row
    for name, rows in merged.items():
        os.makedirs(f"{root}/{name}", exist_ok=True)
        with open(f"{root}/{name}/part-0.json", "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows.values())
    for names, tables in ((LEGACY_FILES, CSVS), (SURVEY_FILES, SURVEYS)):
        for key, (head, rows) in tables.items():
            with open(f"{root}/{names[key]}", "w", encoding="utf-8", newline="") as f:
                w = csv.writer(f, quoting=csv.QUOTE_ALL)
                w.writerow(head)
                w.writerows(rows)
    return root
