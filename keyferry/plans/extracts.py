"""Source objects and the fields each load reads.

Object and field names are fixed values: they are the data contract of the source system.
Numbers stay texts here (exports mix "12", 12 and 12.0) and are converted by the loads.
"""

from __future__ import annotations

from pyspark.sql import types as T

from ..specs import SourceSpec

BASE = ("Id", "IsDeleted", "CreatedDate", "LastModifiedDate")


def _object(name: str, fields: str, flags: str = "", active_only: bool = True) -> SourceSpec:
    types = {f: T.BooleanType() for f in ("IsDeleted", *flags.split())}
    return SourceSpec(name, BASE + tuple(fields.split()), types, "IsDeleted" if active_only else None)


CONTACT = _object(
    "Contact",
    "FirstName LastName Email Title TNS_Id__c Phone Role_In_Hierarchy__c contact_status__c Gender__c "
    "CommCare_Case_Id__c ReportsToId Location__c",
    active_only=False,
)
PROGRAM = _object("Program__c", "Name", active_only=False)
LOCATION = _object("Location__c", "Name Type__c Parent_Location__c")
PROJECT = _object(
    "Project__c",
    "Name Project_Unique_Id__c Project_Status__c Project_Start_Date__c Project_End_Date__c Program__c "
    "Project_Country__c",
)
PROJECT_ROLE = _object(
    "Project_Role__c",
    "Project__c Staff__c TNS_Id__c Role__c Role_for_CommCare__c Roles_Status__c CommCare_Case_Id__c "
    "Create_In_CommCare__c Sent_to_OpenFn_Status__c Project_Location__c",
    flags="Create_In_CommCare__c",
)
WORKER_GROUP = SourceSpec(
    "CommCare_Mobile_Worker_Group_Id__c", ("Location_Id__c", "CC_Mobile_Worker_Group_Id__c"), {}, None
)
TRAINING_MODULE = _object(
    "Training_Module__c",
    "Name Module_Title__c Module_Number__c Project__c Current_Training_Module__c Current_Previous_Module__c "
    "Module_Status__c Sample_AA_FV_Farmers__c",
    flags="Current_Training_Module__c Sample_AA_FV_Farmers__c",
)
TRAINING_GROUP = _object(
    "Training_Group__c",
    "Name Project__c Responsible_Staff__c TNS_Id__c CommCare_Case_Id__c Create_In_CommCare__c "
    "Sent_to_OpenFn_Status__c Group_Status__c FV_AA_Current_Sampling_Round__c Location__c",
    flags="Create_In_CommCare__c",
)
TRAINING_SESSION = _object(
    "Training_Session__c",
    "Training_Group__c Training_Module__c Trainer__c CommCare_Case_Id__c Create_In_CommCare__c "
    "Sent_to_OpenFn_Status__c Date__c Location_GPS__Latitude__s Location_GPS__Longitude__s Altitude__c "
    "Male_Attendance__c Female_Attendance__c Number_in_Attendance__c Date_2__c "
    "Second_Location_GPS__Latitude__s Second_Location_GPS__Longitude__s Second_Altitude__c "
    "Second_Male_Attendance__c Second_Female_Attendance__c Second_Number_in_Attendance__c "
    "Male_Count_Light_Full__c Female_Count_Light_Full__c Total_Count_Light_Full__c",
    flags="Create_In_CommCare__c",
)
TRAINING_SESSION_PHOTOS = _object("Training_Session__c", "Session_Photo_URL__c Session_Photo_URL_2__c")
HOUSEHOLD = _object(
    "Household__c",
    "Name Training_Group__c CommCare_Case_Id__c Household_ID__c Household_Number__c Farm_Size__c "
    "Farm_Size_Before__c Farm_Size_After__c Planted_After_Maria__c Status__c FV_AA_Sampled__c FV_AA_Visited__c "
    "FV_AA_Current_Sampling_Round__c Coffee_Seedlings__c",
    flags="FV_AA_Sampled__c FV_AA_Visited__c",
)
PARTICIPANT_FIELDS = (
    "Training_Group__c Household__c TNS_Id__c CommCare_Case_Id__c Create_In_CommCare__c "
    "Sent_to_OpenFn_Status__c Participant_Full_Name__c Name Last_Name__c Middle_Name__c Gender__c Age__c "
    "Phone_Number__c Primary_Household_Member__c Status__c Status_Notes__c Other_ID_Number__c "
    "National_ID_Number__c"
)


def participant(number_fields=()) -> SourceSpec:
    """Participant extract; ``number_fields`` are further record-number fields of the deployment,
    used in the given order when the main one is empty."""
    return _object("Participant__c", " ".join((PARTICIPANT_FIELDS, *number_fields)), flags="Create_In_CommCare__c")


ATTENDANCE = _object(
    "Attendance__c", "Participant__c Training_Session__c Date__c Status__c Attended__c Submission_ID__c"
)
OBSERVATION = _object(
    "Observation__c",
    "Submission_ID__c Date__c Observer__c Trainer__c Training_Group__c Training_Session__c "
    "Female_Participants__c Male_Participants__c Number_of_Participants__c "
    "Observation_Location__Latitude__s Observation_Location__Longitude__s Altitude__c RecordType.Name "
    "Comments_1__c Comments_2__c Comments_3__c",
    active_only=False,
)
OBSERVATION_RESULT = _object(
    "Observation_Result__c",
    "Submission_ID__c Observation__c Observation_Criterion__r.Name Participant_Sex__c RecordType.Name Result__c "
    "Result_Number__c Result_Text__c Result_Text_Two__c Score__c Comments__c",
    active_only=False,
)
FARM_VISIT = _object(
    "Farm_Visit__c",
    "Date_Visited__c Farm_Visit_Type__c visit_comments__c Latest_Visit__c Household__c Farm_Visited__c "
    "Training_Session__c Farmer_Trainer__c FV_Submission_ID__c Location_GPS__Latitude__s "
    "Location_GPS__Longitude__s Altitude__c Secondary_Farmer__c",
)

# Fixed values of the source contract.
# Best-practice sheets: group -> (answer fields, image fields), and field -> question key.
BEST_PRACTICES = {
    "Health of New Planting": (("health_of_new_planting_choice__c",), ()),
    "Main Stems": (
        ("number_of_main_stems_on_majority_trees__c",), ("photo_of_trees_and_average_main_stems__c",)
    ),
    "Nutrition": (("Color_of_coffee_tree_leaves__c",), ()),
    "Weeding": (
        (
            "how_many_weeds_under_canopy_and_how_big__c",
            "Have_herbicides_been_used_on_the_field__c",
            "has_coffee_field_been_dug__c",
        ),
        ("photo_of_weeds_under_the_canopy__c",),
    ),
    "Shade Management": (
        (
            "level_of_shade_present_on_the_farm__c",
            "planted_intercrop_bananas__c",
            "have_new_shade_been_planted_last_3_years__c",
        ),
        ("photo_of_level_of_shade_on_the_plot__c",),
    ),
    "Record Keeping": (
        ("do_you_have_a_record_book__c", "are_there_records_on_the_record_book__c"),
        ("take_a_photo_of_the_record_book__c",),
    ),
    "Compost": (("Do_you_have_compost_manure__c",), ("photo_of_the_compost_manure__c",)),
    "Stumping": (
        (
            "stumping_method_on_majority_of_trees__c",
            "number_of_trees_stumped__c",
            "year_stumping__c",
            "main_stems_in_majority_coffee_trees__c",
        ),
        ("photos_of_stumped_coffee_trees__c",),
    ),
    "Pesticide Use": (("used_pesticide__c", "pesticide_number_of_times__c", "pesticide_spray_type__c"), ()),
    "Kitchen Garden": (("is_there_a_kitchen_garden__c",), ("photograph_of_kitchen_garden__c",)),
}
# Only the question keys that differ from the field name without its suffix.
QUESTION_KEYS = {
    "Color_of_coffee_tree_leaves__c": "are_the_leave_green_or_yellow_pale_green",
    "Do_you_have_compost_manure__c": "do_you_have_compost_manure",
    "Have_herbicides_been_used_on_the_field__c": "used_herbicides",
    "has_coffee_field_been_dug__c": "has_coffee_field_been_dug__c",
    "have_new_shade_been_planted_last_3_years__c": "new_shade_trees_in_the_last_3_years",
    "how_many_weeds_under_canopy_and_how_big__c": "how_many_weeds_under_canopy_and_how_big_are_they",
    "stumping_method_on_majority_of_trees__c": "stumping_methods_used_on_majority_of_trees",
    "used_pesticide__c": "used_pesticides",
}
ANSWER_FIELDS = {group: fields for group, (fields, _) in BEST_PRACTICES.items()}
IMAGE_FIELDS = {group: images for group, (_, images) in BEST_PRACTICES.items()}
SHEET_FIELDS = {group: fields + images for group, (fields, images) in BEST_PRACTICES.items()}

BEST_PRACTICE = _object(
    "FV_Best_Practices__c",
    " ".join(["Farm_Visit__c FV_Submission_ID__c", *sorted(f for fs in SHEET_FIELDS.values() for f in fs)]),
)

# Legacy files: all-text CSV. Some names have several spellings; the first present one is used.
LEGACY_FILES = {
    "users": "tbl_users.csv",
    "roles": "tbl_roles.csv",
    "project_roles": "tbl_project_role.csv",
    "old_projects": "tbl_projects.csv",
}
OLD_PROJECT_ID = ("id", "project_id")
OLD_PROJECT_SOURCE_ID = ("sf_id", "sf_project_id")
SURVEY_FILES = {
    "wetmills": "wetmills.csv",
    "wetmill_visits": "wetmill_visits.csv",
    "survey_responses": "survey_responses.csv",
    "survey_question_responses": "survey_question_responses.csv",
    "legacy_users": "tbl_users.csv",
}

# Legacy role names and the roles they became; roles that are not tied to a project.
LEGACY_ROLES = {
    "ci_leadership": "CI Leadership",
    "project_manager": "Project Manager",
    "senior_mel_specialist": "Senior MEL Specialist",
    "mel_specialist": "MEL Specialist",
    "mel_analyst": "MEL Specialist",
    "agronomy_advisor": "Agronomy Advisor",
    "senior_agronomy_advisor": "Senior Agronomy Advisor",
    "standard": "Agronomy Advisor",
    "senior_business_advisor": "Senior Business Advisor",
    "business_advisor": "Business Advisor",
    "business_councelor": "Business Advisor",
    "farmer_trainer": "Farmer Trainer",
    "super_admin": "Super Admin",
}
ROLES_WITHOUT_PROJECT = ("Super Admin", "CI Leadership")

SOURCES = {
    "users": CONTACT,
    "programs": PROGRAM,
    "locations": LOCATION,
    "projects": PROJECT,
    "project_staff_roles": PROJECT_ROLE,
    "worker_groups": WORKER_GROUP,
    "training_modules": TRAINING_MODULE,
    "farmer_groups": TRAINING_GROUP,
    "training_sessions": TRAINING_SESSION,
    "training_session_images": TRAINING_SESSION_PHOTOS,
    "households": HOUSEHOLD,
    "farmers": participant(),
    "attendances": ATTENDANCE,
    "observations": OBSERVATION,
    "observation_results": OBSERVATION_RESULT,
    "farm_visits": FARM_VISIT,
    "fv_best_practices": BEST_PRACTICE,
}
