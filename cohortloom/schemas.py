"""Explicit schemas: warehouse extracts, annotated notes and clinical resources.

Resource fields carry their FHIR type in the field metadata (``fhir``), so that schema
driven passes (annotation, allow-listing) need no second description of the model.
``RESOURCES`` describes resources as written to NDJSON; ``stored(resource)`` describes
the columnar table after extension flattening and annotation.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRIMITIVES = {
    "boolean": T.BooleanType(),
    "integer": T.IntegerType(),
    "unsignedInt": T.IntegerType(),
    "positiveInt": T.IntegerType(),
    "decimal": T.DoubleType(),
    **{
        name: T.StringType()
        for name in (
            "string", "code", "uri", "url", "canonical", "oid", "id", "uuid", "fhirid",
            "base64Binary", "instant", "date", "dateTime", "time",
        )
    },
}
DATE_TYPES = ("date", "dateTime", "instant")


def prim(name: str, fhir: str, many: bool = False) -> T.StructField:
    kind = PRIMITIVES[fhir]
    return T.StructField(name, T.ArrayType(kind) if many else kind, True, {"fhir": fhir})


def nested(name: str, fhir: str, fields: list[T.StructField], many: bool = False) -> T.StructField:
    kind = T.StructType(fields)
    return T.StructField(name, T.ArrayType(kind) if many else kind, True, {"fhir": fhir})


CODING_FIELDS = [prim("system", "uri"), prim("code", "code"), prim("display", "string")]


def coding(name: str, many: bool = False) -> T.StructField:
    return nested(name, "Coding", CODING_FIELDS, many)


def concept(name: str, many: bool = False) -> T.StructField:
    return nested(name, "CodeableConcept", [coding("coding", True), prim("text", "string")], many)


def reference(name: str, many: bool = False) -> T.StructField:
    return nested(name, "Reference", [prim("reference", "string")], many)


EXTENSION_VALUES = [
    prim("valueInteger", "integer"),
    prim("valueString", "string"),
    prim("valueCode", "code"),
    prim("valueDate", "date"),
    coding("valueCoding"),
    concept("valueCodeableConcept"),
]
INNER_EXTENSION_FIELDS = [prim("url", "uri"), *EXTENSION_VALUES]
EXTENSION_FIELDS = [
    prim("url", "uri"),
    nested("extension", "Extension", INNER_EXTENSION_FIELDS, True),
    *EXTENSION_VALUES,
]
FLAT_EXTENSION_FIELDS = [prim("url", "uri"), prim("parent", "uri"), *EXTENSION_VALUES]


def extension(name: str) -> T.StructField:
    return nested(name, "Extension", EXTENSION_FIELDS, True)


def coded(name: str) -> T.StructField:
    """A concept that may say where in a text it was found."""
    fields = [coding("coding", True), prim("text", "string"), extension("extension")]
    return nested(name, "CodeableConcept", fields)


def identifier() -> T.StructField:
    fields = [prim("use", "code"), prim("system", "uri"), prim("value", "string")]
    return nested("identifier", "Identifier", fields, True)


META = nested("meta", "Meta", [prim("profile", "canonical", True)])
HEAD = [prim("resourceType", "code"), prim("id", "id")]
NLP_TAIL = [extension("extension"), extension("modifierExtension")]

RESOURCES: dict[str, T.StructType] = {
    "Patient": T.StructType([
        *HEAD,
        META,
        extension("extension"),
        identifier(),
        prim("gender", "code"),
        prim("birthDate", "date"),
        nested("address", "Address", [
            prim("postalCode", "string"), prim("country", "string"), prim("state", "string"),
        ], True),
    ]),
    "Condition": T.StructType([
        *HEAD,
        META,
        concept("clinicalStatus"),
        concept("verificationStatus"),
        concept("category", True),
        coded("code"),
        reference("subject"),
        reference("encounter"),
        prim("onsetDateTime", "dateTime"),
        nested("onsetAge", "Age", [
            prim("value", "decimal"), prim("unit", "string"), prim("system", "uri"), prim("code", "code"),
        ]),
        *NLP_TAIL,
    ]),
    "Observation": T.StructType([
        *HEAD,
        nested("text", "Narrative", [prim("status", "code"), prim("div", "string")]),
        prim("status", "code"),
        concept("category", True),
        coded("code"),
        reference("subject"),
        reference("encounter"),
        prim("effectiveDateTime", "dateTime"),
        concept("valueCodeableConcept"),
        *NLP_TAIL,
    ]),
    "DocumentReference": T.StructType([
        *HEAD,
        prim("status", "code"),
        concept("category", True),
        reference("subject"),
        concept("type"),
        prim("date", "instant"),
        nested("content", "BackboneElement", [
            nested("attachment", "Attachment", [
                prim("contentType", "code"), prim("data", "base64Binary"), prim("url", "url"),
            ]),
        ], True),
        nested("context", "BackboneElement", [reference("encounter", True)]),
    ]),
    "Encounter": T.StructType([
        *HEAD,
        META,
        identifier(),
        prim("status", "code"),
        coding("class"),
        concept("type", True),
        reference("subject"),
        nested("period", "Period", [prim("start", "dateTime"), prim("end", "dateTime")]),
    ]),
    "MedicationStatement": T.StructType([
        *HEAD,
        prim("status", "code"),
        coded("medicationCodeableConcept"),
        reference("subject"),
        *NLP_TAIL,
    ]),
    "Procedure": T.StructType([
        *HEAD,
        prim("status", "code"),
        coded("code"),
        reference("subject"),
        *NLP_TAIL,
    ]),
}

# Types left out of stored tables.
SKIPPED_TYPES = ("Narrative", "markdown", "Resource")


def fhir_type(field: T.StructField) -> str:
    return field.metadata.get("fhir", "Element")


def element_struct(field: T.StructField) -> T.StructType | None:
    """The struct inside a field or inside its array, if any."""
    kind = field.dataType
    if isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return kind if isinstance(kind, T.StructType) else None


def _stored_fields(fields: list[T.StructField], parent_type: str) -> list[T.StructField]:
    out: list[T.StructField] = []
    for field in fields:
        kind = fhir_type(field)
        many = isinstance(field.dataType, T.ArrayType)
        if kind in SKIPPED_TYPES:
            continue
        struct = element_struct(field)
        if kind == "Extension":
            out.append(nested(field.name, kind, _stored_fields(FLAT_EXTENSION_FIELDS, kind), many))
        elif struct is not None:
            out.append(nested(field.name, kind, _stored_fields(struct.fields, kind), many))
        else:
            out.append(field)
        if kind in DATE_TYPES:
            out.append(nested(
                field.name + "_aa", "Annotation", [prim("start", "string"), prim("end", "string")]
            ))
        elif parent_type == "Reference" and field.name == "reference":
            out.append(prim("reference_id_aa", "string"))
        elif kind == "string":
            out.append(prim(field.name + "_aa", "string", many))
    return out


def stored(resource: str) -> T.StructType:
    """Schema of a stored resource table."""
    return T.StructType(_stored_fields(RESOURCES[resource].fields, resource))


# --- inputs ----------------------------------------------------------------------------

EXTRACT_COLUMNS = {
    "note_cohort": ["PATIENT_NUM", "ENCOUNTER_NUM", "CONCEPT_CD", "START_DATE", "OBSERVATION_BLOB"],
    "patient_dimension": ["PATIENT_NUM", "RACE_CD", "SEX_CD", "BIRTH_DATE", "ZIP_CD"],
    "diagnosis": ["PATIENT_NUM", "ENCOUNTER_NUM", "CONCEPT_CD", "START_DATE"],
    "lab_cohort": ["PATIENT_NUM", "ENCOUNTER_NUM", "CONCEPT_CD", "START_DATE", "TVAL_CHAR"],
    "visit_dimension": ["PATIENT_NUM", "ENCOUNTER_NUM", "INOUT_CD", "START_DATE", "END_DATE"],
    "classifier_results": ["ENCOUNTER_NUM", "PREDICTION"],
}

CONCEPT_ATTRIBUTE = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("cui", T.StringType()),
    T.StructField("tui", T.StringType()),
    T.StructField("codingScheme", T.StringType()),
])
MENTION = T.StructType([
    T.StructField("begin", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("polarity", T.IntegerType()),
    T.StructField("conceptAttributes", T.ArrayType(CONCEPT_ATTRIBUTE)),
])
ANNOTATIONS = T.MapType(T.StringType(), T.ArrayType(MENTION))
ANNOTATED_NOTE = T.StructType([
    T.StructField("PATIENT_NUM", T.StringType()),
    T.StructField("ENCOUNTER_NUM", T.StringType()),
    T.StructField("START_DATE", T.StringType()),
    T.StructField("OBSERVATION_BLOB", ANNOTATIONS),
])
