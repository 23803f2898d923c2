"""Fixed values.

Everything in this file must keep exactly these values for results to be right: weights, texts,
word lists, column names and search grids. Nothing here is logic.
"""

# --- Fixed values: priority and solvability weights -------------------------------------------
PRIORITY_WEIGHTS = {
    "Eminence": 0.2,
    "Solvability": 0.6,
    "Strength_of_Case": 0.2,
}
SOLVABILITY_WEIGHTS = {
    "Victim_Willing_to_Testify": 2.0,
    "Bio_and_Location_of_Suspect": 2.0,
    "Other_Suspect(s)_Arrested": 1.0,
    "Police_Willing_to_Arrest": 1.0,
    "Recency_of_Case": 4.0,
    "Exploitation_Reported": 2.0,
    "PV_Believes": 2.0,
}
RECENCY_DISCOUNT_COEF = 0.01
RECENCY_DISCOUNT_EXP = 1.0
RECENCY_V2_MAX_DAYS = 100
BELIEF_WEIGHTS = {
    "pv_believes_definitely_trafficked_many": 1.0,
    "pv_believes_trafficked_some": 0.9,
    "pv_believes_suspect_trafficker": 0.5,
    "pv_believes_not_a_trafficker": 0.0,
}
EXPLOITATION_WEIGHTS = {
    "exploitation_forced_prostitution_exp": 0.5,
    "exploitation_sexual_abuse_exp": 0.45,
    "exploitation_physical_abuse_exp": 0.3,
    "exploitation_debt_bondage_exp": 0.4,
    "exploitation_forced_labor_exp": 0.5,
    "exploitation_organ_removal_exp": 0.5,
    "exploitation_forced_prostitution_occ": 1.0,
    "exploitation_sexual_abuse_occ": 0.9,
    "exploitation_physical_abuse_occ": 0.6,
    "exploitation_debt_bondage_occ": 0.8,
    "exploitation_forced_labor_occ": 1.0,
    "exploitation_organ_removal_occ": 1.0,
}
WILLING_SATURATION = 7
EMINENCE_CAP = 9.0
NETWORK_LINK_OFFSET = 9
PUBLISHED_ROWS = 200
TRAINING_CUTOFF_DAYS = 90

# --- Fixed values: status texts ---------------------------------------------------------------
STEP_COMPLETE = "Step Complete"
VICTIM_WILLING_STATUS = "Step Complete: Victim is willing to press charges"
SUSPECT_LOCATED_STATUS = "Step Complete: Identity and Location Confirmed"
ALREADY_ARRESTED_STATUS = "Closed: Already in Legal Cases Sheet"
CASE_STATUS_POLICE = "Third Step Complete - Police are willing to arrest suspect."
CASE_STATUS_LOCATED = "Second Step Complete: Suspect Located"
CASE_STATUS_TWO_WILLING = "First Step Complete: Two or more PVs willing to testify"
CASE_STATUS_ONE_WILLING = "First Step Complete: One PV willing to testify"
NEXT_ACTION_ARREST = "Ensure Arrest is Made"
NEXT_ACTION_POLICE = "Ask Police to Arrest"
NEXT_ACTION_LOCATE = "Locate Suspect"
NEXT_ACTION_CONTACT = "Contact Victim"
EXCLUDED_ROLES = ("Complainant", "Witness")
CLOSE_DATE_FORMAT = "MM/dd/yyyy"

# --- Fixed values: narrative sentences, in rule order -------------------------------------------
NARRATIVE_BROKER = ("recruited_broker", "They were recruited by a broker. ")
NARRATIVE_RECRUITED = (
    ("how_recruited_promised_job", "Recruited by job promise. "),
    ("how_recruited_married", "Recruited by marriage. "),
    ("how_recruited_promised_marriage", "Recruited by marriage promise. "),
    ("how_recruited_at_work", "Recruited at work. "),
    ("how_recruited_at_school", "Recruited at school. "),
    ("how_recruited_job_ad", "Recruited through job ad. "),
    ("how_recruited_broker_online", "Recruited online. "),
    ("how_recruited_broker_approached", "Recruited by broker approaching them. "),
    ("how_recruited_broker_through_friends", "Recruited through friends. "),
    ("how_recruited_broker_through_family", "Recruited through family. "),
)
NARRATIVE_TRAVEL = (
    ("travel_expenses_paid_themselves", "They paid the travel expenses themselves. "),
    ("travel_expenses_paid_by_broker", "The broker paid the travel expenses. "),
)
NARRATIVE_EARNING = ("Broker said they would be earning ", " per month. ")
NARRATIVE_PURPOSE = (
    ("purpose_for_leaving_education", "Left home for education. "),
    ("purpose_for_leaving_travel_tour", "Left home for travel or tour. "),
    ("purpose_for_leaving_marriage", "Left home for marriage. "),
    ("purpose_for_leaving_family", "Left home for family. "),
    ("purpose_for_leaving_medical", "Left home for medical reasons. "),
    ("purpose_for_leaving_job_hotel", "Left home for job at hotel. "),
    ("purpose_for_leaving_job_household", "Left home for household job. "),
)
NARRATIVE_DESTINATION = ("Planned destination: ", " ")
NARRATIVE_ID = (
    ("id_made_no", "No ID made. "),
    ("id_made_real", "Real ID made. "),
    ("id_made_fake", "Fake ID made. "),
    ("id_made_false_name", "ID with false name made. "),
    ("id_made_other_false", "ID made with other false info. "),
)
NARRATIVE_LEGAL = ("yes", "Legal Case Filed. ")
NARRATIVE_BELIEF = (
    ("Definitely", "PV believes the suspect has definitely trafficked many. "),
    ("some", "PV believes the suspect has trafficked some. "),
    ("Suspect", "PV suspects they are a trafficker. "),
    ("Don", "PV does not believe the suspect is a trafficker. "),
)

# --- Fixed values: word lists for features ------------------------------------------------------
BELIEF_WORDS = (
    ("pv_believes_definitely_trafficked_many", "Definitely"),
    ("pv_believes_trafficked_some", "some"),
    ("pv_believes_suspect_trafficker", "Suspect"),
    ("pv_believes_not_a_trafficker", "Don"),
)
GULF_WORDS = ("Gulf", "Kuwait", "Dubai", "UAE", "Oman", "Saudi", "Iraq", "Qatar", "Bahrain")
UNKNOWN_DESTINATION_WORD = "know"
PLACES_V3 = ("Kampala", "Kyegegwa", "Nairobi", "Kenya")
PLACES_V2 = ("Nepal", "India", "Delhi", "Gorakhpur", "Bihar", "Mumbai", "Sunauli", "Banaras",
             "Kolkata")

# --- Fixed values: column lists -------------------------------------------------------------------
NUMBER_FEATURES_V3 = ("total_blue_flags", "number_of_traffickers", "number_of_victims",
                      "expected_earning")
NUMBER_FEATURES_V2 = ("number_of_victims", "number_of_traffickers", "known_broker_years",
                      "known_broker_months", "married_broker_years", "married_broker_months",
                      "reported_blue_flags", "total_blue_flags", "suspected_trafficker_count")
CATEGORY_FEATURES_V2 = ("education", "station_id", "role", "pv_occupation", "occupation")
FEATURE_DROP_V3 = ("arrested", "station_id", "cif_id", "pb_number", "role", "planned_destination",
                   "pv_believes", "legal_action_taken", "station_name")
FORM_DROP_V2 = (
    "id", "date_time_entered_into_system", "status", "location", "date_time_last_updated",
    "staff_name", "informant_number", "case_notes", "pv_signed_form", "consent_for_fundraising",
    "social_media", "legal_action_taken_filed_against", "officer_name", "cif_id", "person_id",
    "flag_count", "main_pv_id", "expected_earning", "expected_earning_currency",
    "travel_expenses_paid_to_broker_amount", "broker_relation",
    "travel_expenses_broker_repaid_amount", "form_entered_by_id", "source_of_intelligence",
    "incident_date", "how_recruited_broker_other", "legal_action_taken",
    "legal_action_taken_case_type", "appearance", "date_visit_police_station",
    "victim_statement_certified_date", "purpose_for_leaving_other", "relation_to_pv",
    "exploitation_other_value",
)
FORM_DROP_WORDS_V2 = ("contact", "_lb", "guardian")
ROW_IDENTITY_COLUMNS = ("suspect_id", "interview_date", "case_notes", "cif_number", "person_id")
LABEL_LIKE_COLUMNS = ("arrested", "Arrested", "arrest", "Arrest", "Name", "name", "Case_ID",
                      "case_id", "Total_Arrests", "total_arrests", "soc", "days")

# --- Fixed values: case form flags -----------------------------------------------------------------
CASE_FORM_FLAGS = (
    "recruited_agency", "recruited_broker", "recruited_no",
    "how_recruited_promised_job", "how_recruited_married", "how_recruited_promised_marriage",
    "how_recruited_at_work", "how_recruited_at_school", "how_recruited_job_ad",
    "how_recruited_broker_online", "how_recruited_broker_approached",
    "how_recruited_broker_through_friends", "how_recruited_broker_through_family",
    "how_recruited_broker_called_pv",
    "travel_expenses_paid_themselves", "travel_expenses_paid_by_broker",
    "purpose_for_leaving_education", "purpose_for_leaving_travel_tour",
    "purpose_for_leaving_marriage", "purpose_for_leaving_family", "purpose_for_leaving_medical",
    "purpose_for_leaving_job_hotel", "purpose_for_leaving_job_household",
    "id_made_no", "id_made_real", "id_made_fake", "id_made_false_name", "id_made_other_false",
    "exploitation_forced_prostitution_occ", "exploitation_forced_labor_occ",
    "exploitation_physical_abuse_occ", "exploitation_sexual_abuse_occ",
    "exploitation_debt_bondage_occ", "exploitation_organ_removal_occ",
    "exploitation_forced_prostitution_exp", "exploitation_forced_labor_exp",
    "exploitation_physical_abuse_exp", "exploitation_sexual_abuse_exp",
    "exploitation_debt_bondage_exp", "exploitation_organ_removal_exp",
)

# --- Fixed values: graph dimensions ---------------------------------------------------------------
EDGE_TYPES = (
    (1, "Facebook Friend", 3),
    (2, "Facebook Like", 2),
    (3, "Phone Contact", 5),
    (4, "Phone Call", 4),
    (5, "SMS", 4),
)
ACCOUNT_TYPES = ((1, "Facebook"), (2, "Phone"))
EDGE_BOTH, EDGE_OUT, EDGE_IN = 1, 2, 3
ACCOUNT_FACEBOOK, ACCOUNT_PHONE = 1, 2

# --- Fixed values: forest search grids --------------------------------------------------------------
GRID_V3 = {
    "bootstrap": (False, True),
    "num_trees": (10, 100),
    "max_depth": (20, 30),
    "feature_fraction": ("0.5", "0.6"),
    "class_weight": ("balanced", None),
}
GRID_V3_FOLDS = 4
GRID_V2 = {
    "bootstrap": (False, True),
    "num_trees": (10, 100),
    "max_depth": (5, 10, 20, 30, 40, 50, None),
    "feature_fraction": ("0.5", "0.6", "0.7", "0.8", "1"),
    "class_weight": ("balanced", "balanced_subsample", None),
}
GRID_V2_FOLDS = 5
