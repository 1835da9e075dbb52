"""Input schemas of the clinical resources, as DDL strings for ``from_json``.

Only the fields the operators read are listed, and value and date leaves are
strings on purpose: the lexical text of a number or date is what ends up in the
long tables, so nothing is lost to a numeric round trip.
"""

CODING = "struct<system:string,code:string,display:string>"
CODEABLE = f"struct<coding:array<{CODING}>>"
QUANTITY = "struct<value:string,unit:string>"

PATIENT = (
    "struct<id:string,birthDate:string,"
    "identifier:array<struct<system:string,value:string>>>"
)

COMPONENT = (
    f"struct<code:{CODEABLE},valueQuantity:{QUANTITY},valueInteger:string,"
    "valueString:string,valueBoolean:string,valueDateTime:string,"
    f"valueCodeableConcept:{CODEABLE}>"
)

OBSERVATION = (
    "struct<id:string,effectiveDateTime:string,subject:struct<reference:string>,"
    f"code:{CODEABLE},valueQuantity:{QUANTITY},valueInteger:string,valueString:string,"
    f"valueCodeableConcept:{CODEABLE},component:array<{COMPONENT}>>"
)

_RESPONSE_ANSWER = (
    f"valueCoding:{CODING},valueString:string,valueInteger:string,valueDecimal:string,"
    "valueBoolean:string,valueDate:string,valueDateTime:string,valueTime:string,"
    f"valueUri:string,valueQuantity:{QUANTITY}"
)


def response_item(levels: int) -> str:
    """An answered item with ``levels`` typed levels of items below it.

    Items nest without limit and Spark has no recursive type: below the typed
    levels the children are kept as raw JSON texts.
    """
    child = "string" if levels == 0 else response_item(levels - 1)
    return (
        f"struct<linkId:string,text:string,item:array<{child}>,"
        f"answer:array<struct<{_RESPONSE_ANSWER},item:array<{child}>>>>"
    )


def questionnaire_item(levels: int) -> str:
    """A defined item with ``levels`` typed levels of items below it."""
    child = "string" if levels == 0 else questionnaire_item(levels - 1)
    return (
        f"struct<linkId:string,text:string,answerValueSet:string,item:array<{child}>,"
        f"answerOption:array<struct<valueCoding:{CODING}>>>"
    )


def questionnaire_response(levels: int) -> str:
    return (
        "struct<id:string,authored:string,questionnaire:string,"
        f"subject:struct<reference:string>,item:array<{response_item(levels)}>>"
    )


def questionnaire(levels: int) -> str:
    return f"struct<id:string,item:array<{questionnaire_item(levels)}>>"


BUNDLE = "struct<resourceType:string,entry:array<struct<resource:string>>>"

# The resource types handled, in bundle order.
PATIENT_TYPE = "Patient"
OBSERVATION_TYPE = "Observation"
RESPONSE_TYPE = "QuestionnaireResponse"
QUESTIONNAIRE_TYPE = "Questionnaire"
RESOURCE_TYPES = (PATIENT_TYPE, OBSERVATION_TYPE, RESPONSE_TYPE, QUESTIONNAIRE_TYPE)

# The column carrying the date of a resource, for the date window.
DATE_FIELD = {OBSERVATION_TYPE: "effectiveDateTime", RESPONSE_TYPE: "authored"}

# The column names of the data dictionary and its value sets.
DICTIONARY_COLUMNS = (
    "Variable",
    "Name",
    "Description",
    "Datatype",
    "Property URL (ontology)",
    "Unit",
    "Study",
    "Group",
    "Subpopulation",
    "Sample Size",
    "Data Owner",
    "Identifier",
    "Selection",
    "Parent Group",
    "Responsible",
    "Note",
    "Min Value",
    "Max Value",
    "Required",
    "Conditional On",
)
VALUE_SET_COLUMNS = ("Variable", "Code", "Display")

# The columns read from a REDCap dictionary export.
REDCAP_COLUMNS = (
    "Variable / Field Name",
    "Form Name",
    "Section Header",
    "Field Type",
    "Field Label",
    "Choices, Calculations, OR Slider Labels",
    "Field Note",
    "Text Validation Type OR Show Slider Number",
    "Text Validation Min",
    "Text Validation Max",
    "Identifier?",
    "Branching Logic (Show field only if...)",
    "Required Field?",
)
