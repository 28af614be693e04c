"""The health-plan model: tables, columns, classes, tags and mask bindings.

One specification per table carries everything known about a column; schemas,
data dictionary, tags and masking policy are all derived from it. Only columns
that something has to be done about are tagged and bound; the rest pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_NAME = "health_plan"
SCHEMA_COMMENT = "Health-plan tables with classified columns and tier-based masking"

PHI, PII, SENSITIVE, NON_SENSITIVE = "PHI", "PII", "Sensitive", "Non-sensitive"
CLASSES = (PHI, PII, SENSITIVE, NON_SENSITIVE)

# Sensitivity that goes with a class, allowed values of the
# governed tags, tags of the schema.
SENSITIVITY = {PHI: "critical", PII: "critical", SENSITIVE: "high"}
ALLOWED_TAG_VALUES = {
    "sensitivity_level": ("critical", "high", "medium", "low"),
    "compliance": ("hipaa", "hitech", "pci_dss", "sox", "state_privacy"),
    "retention": ("7_year", "10_year", "3_year", "indefinite"),
    "business_domain": (
        "member",
        "claims",
        "provider",
        "eligibility",
        "pharmacy",
        "utilization_management",
    ),
    "masking_rule": ("full_mask", "partial_mask", "hash", "redact", "none"),
}
SCHEMA_TAGS = {"compliance": "hipaa"}

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(12,2)": T.DecimalType(12, 2),
}


@dataclass(frozen=True)
class ColumnSpec:
    """A column: its type, class and, if tagged, its rule and mask."""

    name: str
    type: str
    klass: str
    description: str
    rule: str | None = None
    hipaa_type: str | None = None
    mask: str | None = None

    @property
    def comment(self) -> str:
        return f"{self.description}. {self.klass}."

    @property
    def tags(self) -> dict[str, str]:
        if self.klass == NON_SENSITIVE:
            return {}
        tags = {"sensitivity_level": SENSITIVITY[self.klass], "masking_rule": self.rule}
        if self.hipaa_type:
            tags["hipaa_type"] = self.hipaa_type
        if self.klass in (PHI, PII):
            tags[f"contains_{self.klass.lower()}"] = "true"
        return tags


@dataclass(frozen=True)
class TableSpec:
    """A table with its properties and tags."""

    name: str
    domain: str
    retention: str
    contains_phi: bool
    comment: str
    columns: tuple[ColumnSpec, ...] = field(repr=False)

    @property
    def key(self) -> str:
        """The column that tells rows apart: always the first."""
        return self.columns[0].name

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, _TYPES[c.type], True, {"comment": c.comment, **c.tags})
                for c in self.columns
            ]
        )

    @property
    def properties(self) -> dict[str, str]:
        return {
            "quality": "gold",
            "domain": self.domain,
            "phi_contains": str(self.contains_phi).lower(),
        }

    @property
    def tags(self) -> dict[str, str]:
        return {"business_domain": self.domain, "retention": self.retention}

    @property
    def policy(self) -> dict[str, str]:
        """Column to masking function."""
        return {c.name: c.mask for c in self.columns if c.mask}


def _phi(name, hipaa_type, rule, mask, description, type="string"):
    return ColumnSpec(name, type, PHI, description, rule, hipaa_type, mask)


def _pii(name, hipaa_type, rule, mask, description):
    return ColumnSpec(name, "string", PII, description, rule, hipaa_type, mask)


def _sensitive(name, mask, description, type="string", rule="redact"):
    return ColumnSpec(name, type, SENSITIVE, description, rule, None, mask)


def _plain(name, description, type="string"):
    return ColumnSpec(name, type, NON_SENSITIVE, description)


def _person_id(name, description):
    return _phi(name, "unique_identifier", "hash", "hash_identifier", description)


def _care_date(name, description):
    rule, mask = "partial_mask", "mask_date_of_birth"
    return _phi(name, "date_element", rule, mask, description, "date")


def _amount(name, description, type="decimal(12,2)"):
    return _sensitive(name, "mask_financial_amount", description, type)


def _rx_amount(name, description):
    return _amount(name, description, "decimal(10,2)")


def _stamps():
    return (
        _plain("created_at", "When the record was created", "timestamp"),
        _plain("updated_at", "When the record last changed", "timestamp"),
    )


# Table and column names, types, classes, tag values and the
# masking function each tagged column is meant for.
MEMBERS = TableSpec(
    "members", "member", "7_year", True,
    "Members and subscribers with contact, government-identifier and plan data",
    (
        _person_id("member_id", "Identifier of the member"),
        _person_id("subscriber_id", "Identifier of the policy holder"),
        _pii("first_name", "name", "full_mask", "mask_name", "Given name"),
        _pii("last_name", "name", "full_mask", "mask_name", "Family name"),
        _pii("middle_initial", "name", "full_mask", "mask_name", "Initial of the middle name"),
        _care_date("date_of_birth", "Birth date"),
        _plain("gender", "Administrative gender"),
        _pii("ssn", "ssn", "full_mask", "mask_ssn", "Social security number"),
        _pii("drivers_license", "government_id", "full_mask", "mask_ssn", "Driving licence"),
        _phi("address_line1", "geographic", "full_mask", "mask_address", "Street and number"),
        _phi("address_line2", "geographic", "full_mask", "mask_address", "Flat or suite"),
        _phi("city", "geographic", "redact", "mask_address", "City of residence"),
        _plain("state_code", "State of residence"),
        _phi("zip_code", "geographic", "partial_mask", "mask_zip_code", "Postal code"),
        _phi("county", "geographic", "redact", "mask_address", "County of residence"),
        _phi("phone_home", "telephone", "partial_mask", "mask_phone", "Phone at home"),
        _phi("phone_mobile", "telephone", "partial_mask", "mask_phone", "Mobile phone"),
        _phi("email", "email_address", "partial_mask", "mask_email", "Mail address"),
        _plain("preferred_language", "Language for letters and calls"),
        _sensitive("race", "mask_redact", "Race as reported by the member"),
        _sensitive("ethnicity", "mask_redact", "Ethnicity as reported by the member"),
        _plain("marital_status", "Marital status"),
        _plain("pcp_npi", "NPI of the primary care physician"),
        _phi("medicare_beneficiary_id", "health_plan_beneficiary", "full_mask",
             "mask_beneficiary_id", "Federal beneficiary number"),
        _phi("medicaid_id", "health_plan_beneficiary", "full_mask",
             "mask_beneficiary_id", "State beneficiary number"),
        _plain("group_number", "Group of the employer"),
        _plain("plan_code", "Plan product"),
        _plain("effective_date", "First day of coverage", "date"),
        _plain("termination_date", "Last day of coverage", "date"),
        _plain("is_active", "Whether coverage is in force", "boolean"),
        *_stamps(),
        _plain("source_system", "System the record came from"),
    ),
)

CLAIMS = TableSpec(
    "claims", "claims", "10_year", True,
    "Medical claims with service dates, codes, amounts and provider references",
    (
        _plain("claim_id", "Identifier of the claim"),
        _person_id("member_id", "Member the claim is for"),
        _person_id("subscriber_id", "Policy holder of the claim"),
        _plain("claim_type", "Kind of claim form"),
        _plain("claim_status", "State of adjudication"),
        _care_date("service_date_from", "First day of service"),
        _care_date("service_date_to", "Last day of service"),
        _care_date("admission_date", "Day of admission"),
        _care_date("discharge_date", "Day of discharge"),
        _sensitive("diagnosis_code_primary", "mask_diagnosis_code", "First diagnosis"),
        _sensitive("diagnosis_code_2", "mask_diagnosis_code", "Second diagnosis"),
        _sensitive("diagnosis_code_3", "mask_diagnosis_code", "Third diagnosis"),
        _sensitive("procedure_code", "mask_redact", "Procedure performed"),
        _plain("procedure_modifier", "Modifier of the procedure"),
        _plain("revenue_code", "Revenue class of a facility claim"),
        _plain("place_of_service", "Where the service took place"),
        _plain("rendering_provider_npi", "NPI of the treating provider"),
        _plain("billing_provider_npi", "NPI of the billing provider"),
        _plain("referring_provider_npi", "NPI of the referring provider"),
        _plain("facility_name", "Facility"),
        _amount("billed_amount", "Amount billed"),
        _amount("allowed_amount", "Amount allowed by contract"),
        _amount("paid_amount", "Amount paid by the plan"),
        _amount("member_liability", "Amount owed by the member"),
        _amount("copay_amount", "Copay"),
        _amount("coinsurance_amount", "Coinsurance"),
        _amount("deductible_amount", "Deductible"),
        _sensitive("drg_code", "mask_diagnosis_code", "Diagnosis-related group of the stay"),
        _plain("authorization_number", "Prior authorization of the claim"),
        _plain("received_date", "Day the claim came in", "date"),
        _plain("adjudicated_date", "Day the claim was decided", "date"),
        _plain("paid_date", "Day the claim was paid", "date"),
        *_stamps(),
    ),
)

PROVIDERS = TableSpec(
    "providers", "provider", "7_year", False,
    "Directory of providers; only tax id and prescriber registration are masked",
    (
        _plain("provider_id", "Identifier of the provider"),
        _plain("npi", "National provider identifier"),
        _pii("tax_id", "tax_id", "full_mask", "mask_tax_id", "Tax number"),
        _plain("first_name", "Given name"),
        _plain("last_name", "Family name"),
        _plain("organization_name", "Practice or facility"),
        _plain("specialty_code", "Code of the specialty"),
        _plain("specialty_desc", "Name of the specialty"),
        _plain("provider_type", "Person or organization"),
        _plain("network_status", "Network membership"),
        _plain("credential", "Credential"),
        _sensitive("dea_number", "mask_drug_info", "Prescriber registration", rule="full_mask"),
        _plain("license_number", "State license"),
        _plain("license_state", "State of the license"),
        _plain("address_line1", "Street of the practice"),
        _plain("city", "City of the practice"),
        _plain("state_code", "State of the practice"),
        _plain("zip_code", "Postal code of the practice"),
        _plain("phone", "Phone of the practice"),
        _plain("fax", "Fax of the practice"),
        _plain("accepting_patients", "Whether new patients are taken", "boolean"),
        _plain("effective_date", "First day in the network", "date"),
        _plain("termination_date", "Last day in the network", "date"),
        *_stamps(),
    ),
)

ELIGIBILITY = TableSpec(
    "eligibility", "eligibility", "7_year", True,
    "Coverage spans of members with plan, premium and subsidy",
    (
        _plain("eligibility_id", "Identifier of the span"),
        _person_id("member_id", "Member of the span"),
        _person_id("subscriber_id", "Policy holder of the span"),
        _plain("plan_code", "Plan product"),
        _plain("plan_description", "Name of the plan"),
        _plain("line_of_business", "Line of business"),
        _plain("coverage_type", "Kind of coverage"),
        _plain("benefit_package", "Benefit level"),
        _plain("effective_date", "First day of coverage", "date"),
        _plain("termination_date", "Last day of coverage", "date"),
        _plain("termination_reason", "Why coverage ended"),
        _plain("group_number", "Group of the employer"),
        _plain("group_name", "Name of the employer"),
        _plain("cobra_flag", "Whether continued after employment", "boolean"),
        _plain("exchange_flag", "Whether bought on the exchange", "boolean"),
        _amount("premium_amount", "Premium per month", "decimal(10,2)"),
        _amount("subsidy_amount", "Subsidy per month", "decimal(10,2)"),
        *_stamps(),
    ),
)

PHARMACY_CLAIMS = TableSpec(
    "pharmacy_claims", "pharmacy", "10_year", True,
    "Dispensed prescriptions with drug and cost",
    (
        _plain("rx_claim_id", "Identifier of the prescription claim"),
        _person_id("member_id", "Member the drug was for"),
        _care_date("fill_date", "Day of dispensing"),
        _sensitive("ndc_code", "mask_drug_info", "Drug code"),
        _sensitive("drug_name", "mask_drug_info", "Name of the drug"),
        _sensitive("drug_class", "mask_drug_info", "Therapeutic class of the drug"),
        _plain("quantity_dispensed", "Quantity", "decimal(10,2)"),
        _plain("days_supply", "Days the quantity lasts", "int"),
        _plain("refill_number", "Number of the refill", "int"),
        _plain("prescriber_npi", "NPI of the prescriber"),
        _plain("pharmacy_npi", "NPI of the pharmacy"),
        _plain("pharmacy_name", "Pharmacy"),
        _plain("formulary_tier", "Tier of the formulary"),
        _plain("daw_code", "Substitution code"),
        _rx_amount("ingredient_cost", "Cost of the drug"),
        _rx_amount("dispensing_fee", "Fee of the pharmacy"),
        _rx_amount("paid_amount", "Amount paid by the plan"),
        _rx_amount("member_copay", "Copay"),
        _plain("prior_auth_required", "Whether authorization was needed", "boolean"),
        _plain("specialty_drug_flag", "Whether a specialty drug", "boolean"),
        *_stamps(),
    ),
)

PRIOR_AUTHORIZATIONS = TableSpec(
    "prior_authorizations", "utilization_management", "7_year", True,
    "Requests for authorization with clinical notes and decision",
    (
        _plain("auth_id", "Identifier of the request"),
        _person_id("member_id", "Member the request is for"),
        _plain("auth_type", "Kind of request"),
        _plain("auth_status", "State of the request"),
        _care_date("request_date", "Day of the request"),
        _plain("decision_date", "Day of the decision", "date"),
        _plain("effective_date", "First day of validity", "date"),
        _plain("expiration_date", "Last day of validity", "date"),
        _sensitive("diagnosis_code", "mask_diagnosis_code", "Diagnosis"),
        _sensitive("procedure_code", "mask_redact", "Procedure asked for"),
        _plain("requesting_provider_npi", "NPI of the requesting provider"),
        _plain("servicing_provider_npi", "NPI of the servicing provider"),
        _plain("facility_name", "Facility"),
        _plain("units_requested", "Units asked for", "int"),
        _plain("units_approved", "Units granted", "int"),
        _sensitive("denial_reason", "mask_redact", "Why the request was denied"),
        _phi("clinical_notes", "medical_record", "full_mask", "mask_clinical_notes",
             "Clinical justification"),
        _plain("peer_reviewer", "Reviewer"),
        _plain("urgency", "Urgency"),
        *_stamps(),
    ),
)

TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (MEMBERS, CLAIMS, PROVIDERS, ELIGIBILITY, PHARMACY_CLAIMS, PRIOR_AUTHORIZATIONS)
}

# Columns bound to mask_redact: tagged `redact`, but no other function fits.
REDACT_ONLY = "mask_redact"

# Child column -> parent column of the model's references.
FOREIGN_KEYS = (
    ("claims", "member_id", "members", "member_id"),
    ("eligibility", "member_id", "members", "member_id"),
    ("pharmacy_claims", "member_id", "members", "member_id"),
    ("prior_authorizations", "member_id", "members", "member_id"),
    ("members", "pcp_npi", "providers", "npi"),
    ("claims", "rendering_provider_npi", "providers", "npi"),
    ("claims", "billing_provider_npi", "providers", "npi"),
    ("claims", "referring_provider_npi", "providers", "npi"),
    ("pharmacy_claims", "prescriber_npi", "providers", "npi"),
    ("pharmacy_claims", "pharmacy_npi", "providers", "npi"),
    ("prior_authorizations", "requesting_provider_npi", "providers", "npi"),
    ("prior_authorizations", "servicing_provider_npi", "providers", "npi"),
    ("claims", "authorization_number", "prior_authorizations", "auth_id"),
)


def class_of_comment(comment: Column) -> Column:
    """Class named at the start of a comment's second sentence, else NULL.

    Only the start counts: a non-sensitive column may well mention PHI later.
    """
    first = F.substring_index(comment, ". ", 1)
    second = F.ltrim(F.substring(comment, F.length(first) + 3, F.length(comment)))
    return F.coalesce(*[F.when(second.startswith(k), F.lit(k)) for k in CLASSES])


def data_dictionary(spark: SparkSession) -> DataFrame:
    """One row per column: table, column, type, comment, class of the comment."""
    rows = [
        (SCHEMA_NAME, t.name, i, c.name, c.type, c.comment)
        for t in TABLES.values()
        for i, c in enumerate(t.columns, 1)
    ]
    schema = (
        "schema_name string, table_name string, position int, column_name string, "
        "data_type string, comment string"
    )
    df = spark.createDataFrame(rows, schema)
    return with_class(df)


def with_class(dictionary: DataFrame) -> DataFrame:
    """A dictionary with the class read from each comment."""
    return dictionary.withColumn("column_class", class_of_comment(F.col("comment")))


def table_properties(spark: SparkSession) -> DataFrame:
    rows = [
        (SCHEMA_NAME, t.name, key, value)
        for t in TABLES.values()
        for key, value in t.properties.items()
    ]
    return spark.createDataFrame(
        rows, "schema_name string, table_name string, property string, value string"
    )


def masking_policy(
    spark: SparkSession, with_redact: bool = True, schema: str | None = None
) -> DataFrame:
    """Mask bindings as rows (table_name, column_name, function_name), of ``schema`` if given."""
    rows = [
        (t.name, column, function)
        for t in TABLES.values()
        for column, function in t.policy.items()
        if with_redact or function != REDACT_ONLY
    ]
    policy = spark.createDataFrame(
        rows, "table_name string, column_name string, function_name string"
    )
    return policy if schema is None else policy.select(F.lit(schema).alias("schema_name"), "*")
