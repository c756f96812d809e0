"""What a valid row of each core table is: columns, types, keys, references and rules."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -------------------------------------------------------------------
DIAGNOSIS_CATEGORIES = (
    "Cardiovascular", "Respiratory", "Endocrine", "Gastrointestinal", "Neurological",
    "Urological", "Musculoskeletal", "Trauma", "Infectious", "Hematological",
    "Mental Health", "Skin", "ENT", "Pediatric",
)
SEVERITIES = ("Mild", "Moderate", "Severe", "Critical", "Chronic")
PROCEDURE_CATEGORIES = (
    "Laboratory", "Radiology", "Cardiology", "Cardiology Intervention", "Surgery",
    "Orthopedic", "Orthopedic Surgery", "Endoscopy", "ICU", "Nephrology", "Hematology",
    "Neurology", "Pulmonology", "Physiotherapy", "Emergency", "Nursing", "Consultation",
    "Diagnostic Assessment", "Dermatology", "Urology",
)
HOSPITAL_TYPES = ("Government", "Private", "Specialized", "Teaching")
DISTRICTS = (
    "El Sharq", "Port Fouad", "El Arab", "El Manakh", "El Zohour", "El Dawahy",
    "Mubarak District",
)
DEPARTMENTS = (
    "Emergency", "ICU", "Internal Medicine", "Cardiology", "Pulmonology", "Neurology",
    "Gastroenterology", "Nephrology", "Endocrinology", "Orthopedics", "General Surgery",
    "Pediatrics", "Obstetrics & Gynecology", "Dermatology", "ENT", "Psychiatry",
    "Oncology", "Radiology", "Laboratory", "Pharmacy",
)
FLOORS = ("1", "2", "3")
EMPLOYMENT = ("Active", "On Leave")
SHIFT_STARTS = ("08:00", "14:00", "20:00")
SHIFT_ENDS = ("14:00", "20:00", "08:00")
BED_TYPES = ("ICU", "Emergency", "Standard")
BED_STATES = ("Occupied", "Available", "Under Maintenance")
GENDERS = ("Male", "Female")
BLOOD_TYPES = ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-")
TRANSACTION_TYPES = ("Purchase", "Dispensing", "Wastage", "Return", "Adjustment")
VISIT_TYPES = ("Emergency", "Outpatient", "Inpatient", "Follow-up", "Routine Check")
VISIT_STATES = ("Completed", "No Show", "Cancelled")
YES_NO = ("Yes", "No")
FREQUENCIES = (
    "Once daily", "Twice daily", "Every 12 hours", "Three times daily", "Every 8 hours",
    "Every 6 hours", "As needed",
)
REFERRAL_STATES = ("Completed", "Pending", "Cancelled")
CLAIM_STATES = ("Approved", "Partially Approved", "Rejected", "Pending Review")
HOME_GOVERNORATE = "Port Said"
# ------------------------------------------------------------------------------------

TEXT = "string"


@dataclass(frozen=True)
class Col:
    """One column: target type, width, and the rules its staged text must meet."""

    name: str
    type: str = TEXT
    width: int | None = None
    required: bool = False
    soft: bool = False  # an unreadable value becomes NULL instead of rejecting the row
    via: str | None = None  # read the text as this type first (numeric staging columns)
    domain: tuple[str, ...] = ()
    low: str | None = None  # inclusive bounds, as SQL number text
    high: str | None = None
    default: str | None = None
    currency: bool = False  # thousands separators and the currency mark may be present


@dataclass(frozen=True)
class Ref:
    """The value of ``column`` must be the key of a row in ``table``."""

    column: str
    table: str
    key: str

    @property
    def reason(self) -> str:
        return "fk:" + self.column.removesuffix("_id").removesuffix("_code")


@dataclass(frozen=True)
class Table:
    schema: str
    name: str
    columns: tuple[Col, ...]
    refs: tuple[Ref, ...] = ()
    uniques: tuple[tuple[str, ...], ...] = ()
    differ: tuple[str, str] | None = None  # two columns that must not be equal
    one_of: tuple[str, str] | None = None  # exactly one of two columns must be filled
    month_of: str | None = None  # date column that names the storage partition
    looked_up_by: str | None = None  # column that single rows are sought by; files are sorted by it
    numbered: str | None = None  # prefix of the keys the table gives out itself
    file: str = ""  # usual name of the delivered file
    renamed: dict[str, str] = field(default_factory=dict)  # header -> column

    @property
    def key(self) -> str:
        return self.columns[0].name

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def key_columns(self) -> set[str]:
        return {self.key, *(r.column for r in self.refs)}


def key(name: str, width: int) -> Col:
    return Col(name, width=width, required=True)


def text(name: str, width: int, required: bool = False, **rules) -> Col:
    return Col(name, width=width, required=required, **rules)


def choice(name: str, width: int, domain: tuple[str, ...], required: bool = True) -> Col:
    return Col(name, width=width, required=required, domain=domain)


def whole(name: str, low: str | None = None, high: str | None = None, **rules) -> Col:
    rules.setdefault("required", True)
    return Col(name, "int", low=low, high=high, **rules)


def money(name: str, precision: int = 10, scale: int = 2, **rules) -> Col:
    return Col(name, f"decimal({precision},{scale})", **rules)


def digits(name: str, required: bool = False) -> Col:
    """A long number kept without a fraction (national numbers, telephone numbers)."""
    return Col(name, "decimal(18,0)", required=required)


def day(name: str, required: bool = True, soft: bool = False) -> Col:
    return Col(name, "date", required=required, soft=soft)


HOSPITAL = Ref("hospital_id", "hospital", "hospital_id")
DEPARTMENT = Ref("department_id", "department", "department_id")
DOCTOR = Ref("doctor_id", "doctor", "doctor_id")
PATIENT = Ref("patient_id", "patient", "patient_id")
DRUG = Ref("drug_id", "drug", "drug_id")
VISIT = Ref("visit_id", "visit", "visit_id")
DIAGNOSIS = Ref("diagnosis_code", "diagnosis", "diagnosis_code")
PROCEDURE = Ref("procedure_code", "medical_procedure", "procedure_code")
PRESCRIPTION = Ref("prescription_id", "prescription", "prescription_id")
CLAIM = Ref("claim_id", "claim", "claim_id")

# In load order: every table comes after the tables it refers to.
TABLES: tuple[Table, ...] = (
    Table(
        "ref", "diagnosis",
        (
            key("diagnosis_code", 4),
            text("diagnosis_name", 100, required=True),
            choice("diagnosis_category", 30, DIAGNOSIS_CATEGORIES),
            choice("severity_level", 10, SEVERITIES),
        ),
        file="diagnoses.csv",
    ),
    Table(
        "ref", "medical_procedure",
        (
            key("procedure_code", 4),
            text("procedure_name", 120, required=True),
            choice("procedure_category", 30, PROCEDURE_CATEGORIES),
            money("expected_amount", required=True, low="0", currency=True),
            Col("complexity_score", "smallint", required=True, low="1", high="5"),
        ),
        file="procedures.csv",
        renamed={"expected_cost": "expected_amount"},
    ),
    Table(
        "ref", "drug",
        (
            key("drug_id", 5),
            text("drug_name", 80, required=True),
            text("generic_name", 60, required=True),
            text("manufacturer", 50, required=True),
            text("drug_category", 30, required=True),
            money("unit_amount", 8, required=True, low="0"),
        ),
        file="drugs.csv",
        renamed={"unit_price": "unit_amount"},
    ),
    Table(
        "hosp", "hospital",
        (
            key("hospital_id", 4),
            text("hospital_name", 80, required=True),
            choice("hospital_type", 15, HOSPITAL_TYPES),
            text("governorate", 20, required=True, default=HOME_GOVERNORATE),
            choice("district", 25, DISTRICTS),
            text("phone", 15),
            whole("total_beds", low="1"),
            whole("icu_capacity", low="1"),
            money("longitude", 9, 6, soft=True),
            money("latitude", 9, 6, soft=True),
            text("manager_name", 100),
            text("manager_email", 150),
            text("manager_phone", 20),
        ),
        file="hospitals.csv",
    ),
    Table(
        "hosp", "department",
        (
            key("department_id", 8),
            key("hospital_id", 4),
            choice("department_name", 40, DEPARTMENTS),
            Col("floor_number", via="int", width=2, required=True, domain=FLOORS),
            text("manager_name", 100),
            text("manager_email", 150),
            Col("manager_phone", via="bigint", width=20, soft=True),
        ),
        refs=(HOSPITAL,),
        file="departments.csv",
    ),
    Table(
        "hosp", "doctor",
        (
            key("doctor_id", 7),
            key("hospital_id", 4),
            key("department_id", 8),
            text("first_name", 50, required=True),
            text("last_name", 50, required=True),
            text("specialty", 40, required=True),
            whole("years_experience", low="1", high="38"),
            text("phone", 12),
            choice("employment_status", 10, EMPLOYMENT),
        ),
        refs=(DEPARTMENT,),
        file="doctors.csv",
    ),
    Table(
        "hosp", "doctor_schedule",
        (
            key("schedule_id", 11),
            key("doctor_id", 7),
            day("shift_date"),
            choice("shift_start", 5, SHIFT_STARTS),
            choice("shift_end", 5, SHIFT_ENDS),
        ),
        refs=(DOCTOR,),
        month_of="shift_date",
        file="doctor_schedules.csv",
    ),
    Table(
        "hosp", "bed",
        (
            key("bed_id", 9),
            key("hospital_id", 4),
            key("department_id", 8),
            text("bed_number", 10, required=True),
            choice("bed_type", 10, BED_TYPES),
            choice("availability_status", 20, BED_STATES),
        ),
        refs=(DEPARTMENT,),
        file="beds.csv",
    ),
    Table(
        "hosp", "icu_status",
        (
            key("icu_status_id", 9),
            key("hospital_id", 4),
            whole("occupied_beds", low="0"),
            whole("available_beds", low="0"),
            Col("update_time", "timestamp_ntz", required=True),
        ),
        refs=(HOSPITAL,),
        month_of="update_time",
        file="icu_status.csv",
    ),
    Table(
        "pat", "patient",
        (
            key("patient_id", 12),
            digits("national_id", required=True),
            text("first_name", 50, required=True),
            text("last_name", 50, required=True),
            choice("gender", 6, GENDERS),
            day("birth_date"),
            digits("phone"),
            text("street", 150),
            text("city", 20),
            text("governorate", 20, required=True, default=HOME_GOVERNORATE),
            choice("blood_type", 3, BLOOD_TYPES, required=False),
            digits("emergency_contact"),
        ),
        uniques=(("national_id",),),
        looked_up_by="national_id",
        file="patients.csv",
    ),
    Table(
        "inv", "drug_inventory",
        (
            key("inventory_id", 9),
            key("hospital_id", 4),
            key("drug_id", 5),
            whole("quantity_available", low="0"),
            whole("reorder_level", low="0"),
            day("expiration_date", required=False, soft=True),
        ),
        refs=(HOSPITAL, DRUG),
        uniques=(("hospital_id", "drug_id"),),
        file="drug_inventory.csv",
    ),
    Table(
        "inv", "drug_transaction",
        (
            key("transaction_id", 9),
            key("drug_id", 5),
            key("hospital_id", 4),
            choice("transaction_type", 12, TRANSACTION_TYPES),
            whole("quantity", low="1"),
            day("transaction_date"),
            text("performed_by", 60),
        ),
        refs=(DRUG, HOSPITAL),
        month_of="transaction_date",
        numbered="DT",
        file="drug_transactions.csv",
    ),
    Table(
        "clin", "visit",
        (
            key("visit_id", 12),
            key("patient_id", 12),
            key("hospital_id", 4),
            key("doctor_id", 7),
            key("department_id", 8),
            day("visit_date"),
            choice("visit_type", 15, VISIT_TYPES),
            key("diagnosis_code", 4),
            text("symptoms", 100),
            choice("visit_status", 10, VISIT_STATES),
            whole("waiting_time", required=False, soft=True),
            money("total_amount", soft=True),
        ),
        refs=(PATIENT, HOSPITAL, DOCTOR, DEPARTMENT, DIAGNOSIS),
        month_of="visit_date",
        looked_up_by="patient_id",
        numbered="VIS",
        file="visits.csv",
    ),
    Table(
        "clin", "medical_record",
        (
            key("record_id", 12),
            key("visit_id", 12),
            text("procedure_code", 4),
            text("diagnosis_notes", 300),
            text("treatment_notes", 200),
            choice("follow_up_required", 3, YES_NO),
        ),
        refs=(VISIT,),
        uniques=(("visit_id",),),
        file="medical_records.csv",
    ),
    Table(
        "clin", "visit_procedure",
        (
            key("visit_procedure_id", 12),
            key("visit_id", 12),
            key("procedure_code", 4),
            money("procedure_amount", required=True, low="0"),
            day("procedure_date"),
        ),
        refs=(VISIT, PROCEDURE),
        month_of="procedure_date",
        file="visit_procedures.csv",
    ),
    Table(
        "clin", "prescription",
        (
            key("prescription_id", 12),
            key("visit_id", 12),
            key("doctor_id", 7),
            day("prescription_date"),
            text("notes", 100),
        ),
        refs=(VISIT, DOCTOR),
        month_of="prescription_date",
        looked_up_by="visit_id",
        file="prescriptions.csv",
    ),
    Table(
        "clin", "prescription_item",
        (
            key("prescription_item_id", 12),
            key("prescription_id", 12),
            key("drug_id", 5),
            text("dosage", 10, required=True),
            choice("frequency", 25, FREQUENCIES),
            whole("duration_days", low="3", high="90"),
            whole("quantity", low="1"),
        ),
        refs=(PRESCRIPTION, DRUG),
        looked_up_by="prescription_id",
        file="prescription_items.csv",
    ),
    Table(
        "hosp", "referral",
        (
            key("referral_id", 9),
            key("patient_id", 12),
            key("from_hospital_id", 4),
            key("to_hospital_id", 4),
            text("referral_reason", 80, required=True),
            day("referral_date"),
            choice("referral_status", 10, REFERRAL_STATES),
        ),
        refs=(
            PATIENT,
            Ref("from_hospital_id", "hospital", "hospital_id"),
            Ref("to_hospital_id", "hospital", "hospital_id"),
        ),
        differ=("from_hospital_id", "to_hospital_id"),
        month_of="referral_date",
        file="referrals.csv",
    ),
    Table(
        "fin", "claim",
        (
            key("claim_id", 12),
            key("patient_id", 12),
            key("visit_id", 12),
            key("hospital_id", 4),
            day("claim_date"),
            money("claim_amount", required=True, low="0"),
            money("approved_amount", soft=True),
            choice("claim_status", 20, CLAIM_STATES),
        ),
        refs=(PATIENT, VISIT, HOSPITAL),
        uniques=(("visit_id",),),
        month_of="claim_date",
        numbered="CLM",
        file="claims.csv",
    ),
    Table(
        "fin", "claim_item",
        (
            key("claim_item_id", 12),
            key("claim_id", 12),
            text("procedure_code", 4),
            text("drug_id", 5),
            money("item_amount", low="0"),
            whole("quantity", low="1", required=False),
        ),
        refs=(CLAIM, PROCEDURE, DRUG),
        one_of=("procedure_code", "drug_id"),
        numbered="CI",
        file="claim_items.csv",
    ),
    Table(
        "fin", "claim_approval",
        (
            key("approval_id", 12),
            key("claim_id", 12),
            text("reviewed_by", 50, required=True),
            choice("approval_status", 20, CLAIM_STATES),
            day("approval_date", required=False, soft=True),
            text("rejection_reason", 80),
        ),
        refs=(CLAIM,),
        uniques=(("claim_id",),),
        month_of="approval_date",
        numbered="APR",
        file="claim_approvals.csv",
    ),
    Table(
        "svc", "patient_feedback",
        (
            key("feedback_id", 12),
            key("patient_id", 12),
            key("hospital_id", 4),
            key("doctor_id", 7),
            Col("rating", "smallint", required=True, low="1", high="5"),
            text("comments", 200),
            day("feedback_date"),
        ),
        refs=(PATIENT, HOSPITAL, DOCTOR),
        month_of="feedback_date",
        file="patient_feedback.csv",
    ),
)

BY_NAME: dict[str, Table] = {t.name: t for t in TABLES}


def core_spelling(domain: tuple[str, ...], value: str | None) -> str | None:
    """A parameter in the spelling the core stores, so that filters are plain equality."""
    if value is None:
        return None
    folded = value.rstrip(" ").upper()
    return next((v for v in domain if v.upper() == folded), value)
