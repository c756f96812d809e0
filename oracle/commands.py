"""The command batches decided in DuckDB: windows for order, recursion for the stock."""

from __future__ import annotations

from carelake.sources.command_batches import BATCHES
from oracle.domain import with_views

AS_OF = "DATE '1998-06-01'"


def codes(*rules: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {rule} THEN '{code}' END" for rule, code in rules) + ")"


def new_id(prefix: str, digits: int, table: str, column: str, order: str) -> str:
    used = f"""coalesce((SELECT max(TRY_CAST(substring({column}, {len(prefix) + 1}) AS BIGINT)) FROM {{{table}}}
        WHERE regexp_full_match({column}, '{prefix}[0-9]+')), 0)"""
    return f"printf('{prefix}%0{digits}d', {used} + row_number() OVER (ORDER BY {order}))"


VIEWS = {
    **BATCHES,
    "register_judged": f"""
        SELECT c.*, {codes(
            ("NOT EXISTS (SELECT 1 FROM {patient} p WHERE p.patient_id = c.patient_id)", "patient:not_found"),
            ("NOT EXISTS (SELECT 1 FROM {doctor} d WHERE d.doctor_id = c.doctor_id AND d.employment_status = 'Active')", "doctor:not_active"),
            ("NOT EXISTS (SELECT 1 FROM {department} w WHERE w.department_id = c.department_id AND w.hospital_id = c.hospital_id)", "department:not_in_hospital"),
            ("NOT EXISTS (SELECT 1 FROM {diagnosis} g WHERE g.diagnosis_code = c.diagnosis_code)", "fk:diagnosis"),
        )} AS reasons
        FROM {{register_commands}} c""",
    "register_ids": f"""
        SELECT seq, {new_id('VIS', 8, 'visit', 'visit_id', 'seq')} AS visit_id FROM {{register_judged}} WHERE reasons = ''""",
    "dispense_commands": """
        SELECT row_number() OVER (ORDER BY source_id) AS seq, hospital_id, drug_id, quantity, performed_by
        FROM {dispense_rows}""",
    "dispense_steps": """
        SELECT c.*, i.quantity_available AS stock,
               row_number() OVER (PARTITION BY c.hospital_id, c.drug_id ORDER BY seq) AS turn
        FROM {dispense_commands} c JOIN {drug_inventory} i ON i.hospital_id = c.hospital_id AND i.drug_id = c.drug_id""",
    "dispense_judged": """
        WITH RECURSIVE walk AS (
            SELECT hospital_id, drug_id, turn, seq, quantity, quantity <= stock AS granted,
                   CASE WHEN quantity <= stock THEN stock - quantity ELSE stock END AS remaining
            FROM {dispense_steps} WHERE turn = 1
            UNION ALL
            SELECT s.hospital_id, s.drug_id, s.turn, s.seq, s.quantity, s.quantity <= w.remaining,
                   CASE WHEN s.quantity <= w.remaining THEN w.remaining - s.quantity ELSE w.remaining END
            FROM walk w JOIN {dispense_steps} s
              ON s.hospital_id = w.hospital_id AND s.drug_id = w.drug_id AND s.turn = w.turn + 1)
        SELECT c.seq, c.hospital_id, c.drug_id, c.quantity, walk.granted, walk.remaining,
               CASE WHEN walk.seq IS NULL THEN 'stock:not_found' WHEN granted THEN '' ELSE 'stock:insufficient' END AS reasons
        FROM {dispense_commands} c LEFT JOIN walk ON walk.seq = c.seq""",
    "dispense_ids": f"""
        SELECT seq, {new_id('DT', 7, 'drug_transaction', 'transaction_id', 'seq')} AS transaction_id
        FROM {{dispense_judged}} WHERE reasons = ''""",
    "submit_checked": f"""
        SELECT c.*, v.total_amount AS claim_amount, {codes(
            ("v.visit_id IS NULL", "visit:not_completed"),
            ("k.visit_id IS NOT NULL", "claim:exists"),
            ("v.visit_id IS NOT NULL AND v.total_amount IS NULL", "null:claim_amount"),
            ("v.total_amount < 0", "range:claim_amount"),
        )} AS checks
        FROM {{submit_commands}} c
        LEFT JOIN (SELECT * FROM {{visit}} WHERE visit_status = 'Completed') v ON v.visit_id = c.visit_id
        LEFT JOIN {{claim}} k ON k.visit_id = c.visit_id""",
    "submit_judged": """
        SELECT *, CASE WHEN checks = '' AND row_number() OVER (PARTITION BY visit_id, checks = '' ORDER BY seq) > 1
                       THEN 'claim:exists' ELSE checks END AS reasons FROM {submit_checked}""",
    "submit_ids": f"""
        SELECT seq, visit_id, {new_id('CLM', 8, 'claim', 'claim_id', 'seq')} AS claim_id FROM {{submit_judged}} WHERE reasons = ''""",
    "review_checked": f"""
        SELECT c.*, k.claim_amount AS full_amount, lower(c.new_status) AS status, {codes(
            ("k.claim_id IS NULL", "claim:not_found"),
            ("lower(c.new_status) NOT IN ('approved', 'partially approved', 'rejected')", "status:invalid"),
            ("lower(c.new_status) = 'rejected' AND c.rejection_reason IS NULL", "reason:required"),
            ("r.claim_id IS NOT NULL", "unique:claim_id"),
        )} AS checks
        FROM {{review_commands}} c LEFT JOIN {{claim}} k ON k.claim_id = c.claim_id
        LEFT JOIN {{reviews_so_far}} r ON r.claim_id = c.claim_id""",
    "review_judged": """
        SELECT *, CASE WHEN checks = '' AND row_number() OVER (PARTITION BY claim_id, checks = '' ORDER BY seq) > 1
                       THEN 'unique:claim_id' ELSE checks END AS reasons FROM {review_checked}""",
    "review_ids": f"""
        SELECT *, {new_id('APR', 8, 'reviews_so_far', 'approval_id', 'seq')} AS approval_id,
               CASE status WHEN 'approved' THEN 'Approved' WHEN 'rejected' THEN 'Rejected' ELSE 'Partially Approved' END AS spelled
        FROM {{review_judged}} WHERE reasons = ''""",
}


def sql() -> dict[str, str]:
    texts = {
        "cmd_register_visits":
            "SELECT seq, visit_id, reasons FROM {register_judged} LEFT JOIN {register_ids} USING (seq)",
        "cmd_dispense": """
            SELECT j.seq, i.transaction_id, CASE WHEN granted THEN CAST(j.remaining AS BIGINT) END AS remaining_stock, j.reasons
            FROM {dispense_judged} j LEFT JOIN {dispense_ids} i ON i.seq = j.seq""",
        "cmd_dispense_inventory": """
            SELECT i.inventory_id, i.hospital_id, i.drug_id,
                   CAST(i.quantity_available - coalesce(t.taken, 0) AS INT) AS quantity_available,
                   i.reorder_level, i.expiration_date
            FROM {drug_inventory} i LEFT JOIN (SELECT hospital_id, drug_id, sum(quantity) AS taken
                 FROM {dispense_judged} WHERE reasons = '' GROUP BY ALL) t
              ON t.hospital_id = i.hospital_id AND t.drug_id = i.drug_id""",
        "cmd_submit_claims": """
            SELECT j.seq, i.claim_id, CASE WHEN i.seq IS NOT NULL THEN j.claim_amount END AS claim_amount, j.reasons
            FROM {submit_judged} j LEFT JOIN {submit_ids} i ON i.seq = j.seq""",
        "cmd_submit_claim_items": f"""
            SELECT {new_id('CI', 9, 'claim_item', 'claim_item_id', 'i.seq, p.visit_procedure_id')} AS claim_item_id,
                   i.claim_id, p.procedure_code, CAST(NULL AS VARCHAR) AS drug_id, p.procedure_amount AS item_amount,
                   1 AS quantity
            FROM {{submit_ids}} i JOIN {{visit_procedure}} p ON p.visit_id = i.visit_id""",
        "cmd_review_decisions": """
            SELECT j.seq, i.approval_id, j.reasons FROM {review_judged} j LEFT JOIN {review_ids} i ON i.seq = j.seq""",
        "cmd_review_claims": """
            SELECT c.claim_id, coalesce(i.spelled, c.claim_status) AS claim_status,
                   CASE i.status WHEN 'approved' THEN c.claim_amount WHEN 'partially approved' THEN i.approved_amount
                                 WHEN 'rejected' THEN 0 ELSE c.approved_amount END AS approved_amount
            FROM {claim} c LEFT JOIN {review_ids} i ON i.claim_id = c.claim_id""",
        "cmd_review_approvals": f"""
            SELECT approval_id, claim_id, reviewed_by, spelled AS approval_status, {AS_OF} AS approval_date, rejection_reason
            FROM {{review_ids}}""",
    }
    texts["cmd_dispense_hot"] = texts["cmd_dispense"]  # the same commands, decided in the way of crowded keys
    return {key: with_views(text, VIEWS) for key, text in texts.items()}
