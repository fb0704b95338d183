"""Fixed values.

Every constant in this module is part of the data contract: code systems, URLs, code
lists, label tables and patterns that stored resources and reports must carry verbatim.
They are plain literals and hold no logic.
"""

# --- Fixed values: code systems and extension URLs -------------------------------------

SNOMED = "http://snomed.info/sct"
LOINC = "http://loinc.org"
RXNORM = "http://www.nlm.nih.gov/research/umls/rxnorm"
CUI_SYSTEM = "urn:oid:2.16.840.1.113883.6.86"
TUI_SYSTEM = "http://fhir-registry.smarthealthit.org/CodeSystem/nlp-tui"
OMB_RACE_SYSTEM = "urn:oid:2.16.840.1.113883.6.238"
OBSERVATION_CATEGORY = "http://terminology.hl7.org/CodeSystem/observation-category"
CONDITION_CATEGORY = "http://terminology.hl7.org/CodeSystem/condition-category"
CONDITION_CLINICAL = "http://terminology.hl7.org/CodeSystem/condition-clinical"
CONDITION_VERIFICATION = "http://terminology.hl7.org/CodeSystem/condition-ver-status"
ACT_CODE = "http://terminology.hl7.org/CodeSystem/v3-ActCode"
DOCUMENT_CATEGORY = (
    "http://hl7.org/fhir/us/core/CodeSystem/us-core-documentreference-category"
)
PATIENT_PROFILE = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-patient"
CONDITION_PROFILE = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-condition"
ENCOUNTER_PROFILE = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-encounter"
RACE_EXTENSION = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-race"
POLARITY_URL = "http://fhir-registry.smarthealthit.org/StructureDefinition/nlp-polarity"
ALGORITHM_URL = "http://fhir-registry.smarthealthit.org/StructureDefinition/nlp-algorithm"
CLASSIFIER_URL = "http://fhir-registry.smarthealthit.org/StructureDefinition/nlp-classifier"
TEXT_POSITION_URL = (
    "http://fhir-registry.smarthealthit.org/StructureDefinition/nlp-text-position"
)
CLASSIFIER_CATEGORY_SYSTEM = "NLP Covid classifier"

# --- Fixed values: result and diagnosis codes ------------------------------------------

POSITIVE_CODE = "10828004"
NEGATIVE_CODE = "260385009"
INCONCLUSIVE_CODE = "272519000"
COVID_DIAGNOSIS = "U07.1"
COVID_LOINC = ("94500-6", "95406-5")
CLASSIFIER_LOINC = "94500-6"
CLASSIFIER_V1_NUMBER = 1
CLASSIFIER_V1 = "Covid classifier v1"
CLASSIFIER_202204 = "Covid classifier 202204"
NOT_CLASSIFIED = "Not classified"

# --- Fixed values: lookup tables -------------------------------------------------------

LAB_TO_LOINC = {
    "LAB:1043473617": "94500-6",
    "LAB:1044804335": "94500-6",
    "LAB:1044704735": "94500-6",
    "LAB:1134792565": "95406-5",
    "LAB:1148157467": "95406-5",
    "LAB:467288722": "85477-8",
    "LAB:152831642": "85476-0",
    "LAB:467288694": "85478-6",
    "LAB:467288700": "85479-4",
    "LAB:13815125": "62462-7",
}

RACE_TO_CODE = {
    "White": "2106-3",
    "Black or African American": "2054-5",
    "American Indian or Alaska Native": "1002-5",
    "Asian": "2028-9",
    "Native Hawaiian or Other Pacific Islander": "2076-8",
    "Hispanic or Latino": "2135-2",
    "Not Hispanic or Latino": "2186-5",
}
OMB_RACE_CODES = ("1002-5", "2028-9", "2054-5", "2076-8", "2106-3")

DIAGNOSIS_SYSTEMS = {"ICD9": "ICD-9", "ICD10": "ICD-10"}
UNKNOWN_SYSTEM = "Not Found"
GENDERS = {"F": "female", "M": "male"}
CODING_SCHEMES = {"SNOMEDCT_US": SNOMED, "RXNORM": RXNORM}

# Semantic types of note annotations and the resource each becomes. Only the sign and
# symptom type is kept by default.
DEFAULT_MENTION_TYPES = {"SignSymptomMention": "Observation"}
ALL_MENTION_TYPES = {
    "DiseaseDisorderMention": "Condition",
    "IdentifiedAnnotation": "Observation",
    "SignSymptomMention": "Observation",
    "MedicationMention": "MedicationStatement",
    "ProcedureMention": "Procedure",
}

# Symptom labels by SNOMED code, first edition (22 codes).
SYMPTOMS_A = {
    "68235000": "Congestion or runny nose",
    "64531003": "Congestion or runny nose",
    "49727002": "Cough",
    "11833005": "Cough",
    "28743005": "Cough",
    "62315008": "Diarrhea",
    "84229001": "Fatigue",
    "367391008": "Fatigue",
    "43724002": "Fever or chills",
    "103001002": "Fever or chills",
    "426000000": "Fever or chills",
    "25064002": "Headache",
    "21522001": "Muscle or body aches",
    "29857009": "Muscle or body aches",
    "57676002": "Muscle or body aches",
    "68962001": "Muscle or body aches",
    "422587007": "Nausea or vomiting",
    "422400008": "Nausea or vomiting",
    "44169009": "New loss of taste or smell",
    "36955009": "New loss of taste or smell",
    "267036007": "Shortness of breath or difficulty breathing",
    "162397003": "Sore throat",
}

# Symptom labels by SNOMED code, second edition (20 codes).
SYMPTOMS_B = {
    "68235000": "Congestion or runny nose",
    "64531003": "Congestion or runny nose",
    "49727002": "Cough",
    "11833005": "Cough",
    "28743005": "Cough",
    "62315008": "Diarrhea",
    "84229001": "Fatigue",
    "367391008": "Fatigue",
    "43724002": "Fever or chills",
    "103001002": "Fever or chills",
    "426000000": "Fever or chills",
    "386661006": "Fever or chills",
    "25064002": "Headache",
    "68962001": "Muscle or body aches",
    "422587007": "Nausea or vomiting",
    "422400008": "Nausea or vomiting",
    "44169009": "New loss of taste or smell",
    "36955009": "New loss of taste or smell",
    "267036007": "Shortness of breath or difficulty breathing",
    "162397003": "Sore throat",
}

# Symptom labels by concept identifier (20 identifiers).
SYMPTOMS_CUI = {
    "C0027424": "Congestion or runny nose",
    "C1260880": "Congestion or runny nose",
    "C0010200": "Cough",
    "C0850149": "Cough",
    "C0239134": "Cough",
    "C0011991": "Diarrhea",
    "C0015672": "Fatigue",
    "C0231218": "Fatigue",
    "C0085593": "Fever or chills",
    "C0687681": "Fever or chills",
    "C1959900": "Fever or chills",
    "C0015967": "Fever or chills",
    "C0018681": "Headache",
    "C0231528": "Muscle or body aches",
    "C0027497": "Nausea or vomiting",
    "C0042963": "Nausea or vomiting",
    "C0003126": "New loss of taste or smell",
    "C2364111": "New loss of taste or smell",
    "C0013404": "Shortness of breath or difficulty breathing",
    "C0242429": "Sore throat",
}
OTHER_SYMPTOMS = "Other Symptoms"
NO_SYMPTOMS = "No Covid Symptoms"

# --- Fixed values: text conventions ----------------------------------------------------

# Blank markers of CSV extracts: the usual dataframe-reader defaults.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
NOTE_HEADER = r"^\d{4}-\d{2}-\d{2}"
UNDATED_NOTE = "1900-01-01"
EXTENSION_SEGMENTS = ("modifierExtension", "extension")

# --- Fixed values: de-identification allow-list (path, method, use case) ---------------

ALLOW_RULES_CSV = """\
Patient.extension.url,keep,us_core_patient_info
Patient.extension.extension.url,keep,us_core_patient_info
Patient.extension.extension.valueCoding,keep,us_core_race_ethnicity
Patient.extension.extension.valueString,keep,us_core_race_ethnicity
Patient.extension.valueCode,keep,us_core_birth_Sex
MedicationStatement.medicationCodeableConcept.extension.url,keep,nlp_text_position
MedicationStatement.medicationCodeableConcept.extension.extension.url,keep,nlp_text_position
MedicationStatement.medicationCodeableConcept.extension.extension.valueInteger,keep,nlp_text_position
MedicationStatement.modifierExtension.url,keep,nlp_version
MedicationStatement.modifierExtension.valueInteger,keep,nlp_negation
MedicationStatement.modifierExtension.extension.url,keep,nlp_version_and_info
MedicationStatement.modifierExtension.extension.valueCodeableConcept.coding,keep,nlp_version_and_info
MedicationStatement.modifierExtension.extension.valueCodeableConcept.text,keep,nlp_version_and_info
MedicationStatement.modifierExtension.extension.valueCodeableConcept,keep,nlp_version_and_info
MedicationStatement.modifierExtension.extension.valueDate,keep,nlp_notes_date
MedicationStatement.modifierExtension.extension.valueString,keep,nlp_version_and_info
Observation.code.extension.url,keep,nlp_text_position
Observation.code.extension.extension.url,keep,nlp_text_position
Observation.code.extension.extension.valueInteger,keep,nlp_text_position
Observation.modifierExtension.url,keep,nlp_version
Observation.modifierExtension.valueInteger,keep,nlp_negation
Observation.modifierExtension.extension.url,keep,nlp_version_and_info
Observation.modifierExtension.extension.valueCodeableConcept.coding,keep,nlp_version_and_info
Observation.modifierExtension.extension.valueCodeableConcept.text,keep,nlp_version_and_info
Observation.modifierExtension.extension.valueCodeableConcept,keep,nlp_version_and_info
Observation.modifierExtension.extension.valueDate,keep,nlp_notes_date
Observation.modifierExtension.extension.valueString,keep,nlp_version_and_info
Observation.modifierExtension.valueString,keep,nlp_classifier
Condition.code.extension.url,keep,nlp_text_position
Condition.code.extension.extension.url,keep,nlp_text_position
Condition.code.extension.extension.valueInteger,keep,nlp_text_position
Condition.modifierExtension.url,keep,nlp_version
Condition.modifierExtension.valueInteger,keep,nlp_negation
Condition.modifierExtension.extension.url,keep,nlp_version_and_info
Condition.modifierExtension.extension.valueCodeableConcept.coding,keep,nlp_version_and_info
Condition.modifierExtension.extension.valueCodeableConcept.text,keep,nlp_version_and_info
Condition.modifierExtension.extension.valueCodeableConcept,keep,nlp_version_and_info
Condition.modifierExtension.extension.valueDate,keep,nlp_notes_date
Condition.modifierExtension.extension.valueString,keep,nlp_version_and_info
Procedure.code.extension.url,keep,nlp_text_position
Procedure.code.extension.extension.url,keep,nlp_text_position
Procedure.code.extension.extension.valueInteger,keep,nlp_text_position
Procedure.modifierExtension.url,keep,nlp_version
Procedure.modifierExtension.valueInteger,keep,nlp_negation
Procedure.modifierExtension.extension.url,keep,nlp_version_and_info
Procedure.modifierExtension.extension.valueCodeableConcept.coding,keep,nlp_version_and_info
Procedure.modifierExtension.extension.valueCodeableConcept.text,keep,nlp_version_and_info
Procedure.modifierExtension.extension.valueCodeableConcept,keep,nlp_version_and_info
Procedure.modifierExtension.extension.valueDate,keep,nlp_notes_date
Procedure.modifierExtension.extension.valueString,keep,nlp_version_and_info
Condition.subject,keep,for_table_merge
Observation.subject,keep,for_table_merge
Patient.id,keep,for_table_merge
nodesByType('CodeableConcept').text,keep,uncoded_description
nodesByType('Coding').display,keep,uncoded_description
nodesByType('Reference').reference,keep,keep_for_table_join
nodesByType('date'),keep,temporal_analysis
nodesByType('dateTime'),keep,temporal_analysis
nodesByType('instant'),keep,temporal_analysis
nodesByType('Age'),keep,temporal_analysis
"""
