"""Command batches for the driver queries, as portable SELECTs over the domain views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carelake.core import Core
from carelake.plans.numbering import with_position
from carelake.sources.driver_tables import placeholders

BATCHES: dict[str, str] = {
    "register_commands": """
        SELECT order_no AS seq,
               CASE WHEN order_no % 13 = 0 THEN 'PATNONE' ELSE patient_id END AS patient_id,
               hospital_id, doctor_id,
               CASE WHEN order_no % 11 <> 0 THEN department_id
                    WHEN hospital_id = 'H001' THEN 'DEPT0125' ELSE 'DEPT0001' END AS department_id,
               diagnosis_code, lower(visit_type) AS visit_type, symptoms, waiting_time, total_amount
        FROM {visit}""",
    "dispense_rows": """
        SELECT transaction_id AS source_id, hospital_id, drug_id, quantity, performed_by
        FROM {drug_transaction} WHERE transaction_type = 'Dispensing'""",
    "submit_commands": """
        SELECT order_no * 2 AS seq, visit_id, patient_id, hospital_id FROM {visit}
        UNION ALL
        SELECT order_no * 2 + 1 AS seq, visit_id, patient_id, hospital_id FROM {visit} WHERE order_no % 10 = 0""",
    # Claims still pending have no review yet.
    "reviews_so_far": "SELECT * FROM {claim_approval} WHERE approval_status <> 'Pending Review'",
    "review_rows": """
        SELECT claim_no * 2 AS seq, claim_no AS n, claim_id, claim_amount FROM {claim}
        UNION ALL
        SELECT claim_no * 2 + 1 AS seq, claim_no + 1 AS n, claim_id, claim_amount FROM {claim} WHERE claim_no % 10 = 3""",
    "review_commands": """
        SELECT seq, claim_id,
               'Reviewer ' || CAST(n % 7 AS STRING) AS reviewed_by,
               CASE WHEN n % 12 = 0 THEN 'Maybe' WHEN n % 3 = 0 THEN 'rejected' WHEN n % 3 = 1 THEN 'Approved'
                    ELSE 'Partially Approved' END AS new_status,
               CAST(claim_amount - 50 AS DECIMAL(10,2)) AS approved_amount,
               CASE WHEN n % 3 = 0 AND n % 9 <> 0 THEN 'Reason ' || CAST(n % 5 AS STRING) END AS rejection_reason
        FROM {review_rows}""",
}


def batch(core: Core, name: str) -> DataFrame:
    text = BATCHES[name]
    tables = {dep: batch(core, dep) if dep in BATCHES else core[dep] for dep in placeholders(text)}
    return core.spark.sql(text, **tables)


def dispense_commands(core: Core) -> DataFrame:
    """Dispensing commands in the order of the transactions they are made from."""
    return with_position(batch(core, "dispense_rows"), "source_id", position="seq")
