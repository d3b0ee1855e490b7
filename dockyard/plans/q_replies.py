"""Registered queries for send results + their oracles.

Replies are fixture documents built with ``to_xml`` from f_message
(reply_kind: Failure / error / ok) and shredded again by the operators.
"""

from __future__ import annotations


from dockyard.functions.columns import AS_OF
from dockyard.operators import replies as R
from dockyard.plans.registry import query

TS = f"CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP)"
QCOLS = ["unique_id", "order_number", "message_type", "queue_status", "retries", "error_msg"]

_REPLY = """
WITH rep AS (
  SELECT unique_id, reply_kind, coalesce(retries, 0) AS retries0,
    CASE WHEN reply_kind = 'Failure' THEN 'Failure' WHEN reply_kind = 'nested' THEN 'failure' WHEN reply_kind = 'error' THEN NULL
         ELSE 'Success' END AS result_type,
    CASE WHEN reply_kind = 'Failure' THEN 'E' || CAST(unique_id % 50 AS VARCHAR)
         WHEN reply_kind = 'nested' THEN 'D1' END AS error_code,
    CASE WHEN reply_kind = 'Failure' THEN 'E' || CAST(unique_id % 50 AS VARCHAR) || ':bad request '
                                          || CAST(unique_id AS VARCHAR)
         WHEN reply_kind = 'nested' THEN 'D1:deep ' || CAST(unique_id AS VARCHAR) END AS error_msg,
    CASE WHEN reply_kind = 'error' THEN 'unreachable ' || CAST(unique_id AS VARCHAR) END
      AS protocol_error,
    CAST((unique_id * 37) % 900 + 40 AS INT) AS ms_elapsed
  FROM f_message WHERE queue_status = 1)
"""


def _queue(fx):
    return fx.d_outbound_queue


def _replies(fx):
    return fx.d_replies


@query("pending_messages", """
SELECT unique_id, order_number, message_type, queue_status, retries, error_msg
FROM f_message WHERE queue_status = 0
""")
def q_pending_messages(fx):
    return R.pending_messages(_queue(fx)).select(*QCOLS)


@query("pallet_resend", """
SELECT unique_id, order_number,
  CASE WHEN h THEN 'updatePalletRequest' ELSE message_type END AS message_type,
  CASE WHEN h THEN 0 ELSE queue_status END AS queue_status,
  CASE WHEN h THEN 1 ELSE retries END AS retries,
  CASE WHEN h THEN NULL ELSE error_msg END AS error_msg,
  CASE WHEN h THEN 'updatePalletRequest'
       WHEN message_type = 'addPalletRequest' THEN 'addPalletRequest' ELSE 'message' END AS xml_root
FROM (SELECT f_message.*, coalesce(coalesce(error_msg, '') <> '' AND message_type = 'addPalletRequest'
                                   AND retries = 0, false) AS h
      FROM f_message) m
""")
def q_pallet_resend(fx):
    q = R.pallet_resend(_queue(fx))
    return q.select(*QCOLS, R.root_name("message_xml").alias("xml_root"))


@query("protocol_errors", _REPLY + "SELECT unique_id, protocol_error FROM rep")
def q_protocol_errors(fx):
    return R.protocol_errors(_replies(fx))


@query("retry_plan", _REPLY + """
SELECT unique_id, retries0 + 1 AS next_retries, protocol_error FROM rep
WHERE protocol_error IS NOT NULL AND retries0 < 5
""")
def q_retry_plan(fx):
    return R.retry_plan(_queue(fx), _replies(fx))


@query("reply_result", _REPLY + "SELECT unique_id, result_type, error_code, error_msg FROM rep")
def q_reply_result(fx):
    return R.reply_result(_replies(fx))


@query("message_status", _REPLY + f"""
SELECT m.unique_id, m.order_number, m.message_type,
  CASE WHEN r.unique_id IS NULL THEN m.queue_status
       WHEN coalesce(r.error_msg, '') = '' THEN 2 ELSE 3 END AS queue_status,
  CASE WHEN r.unique_id IS NULL THEN m.retries ELSE r.retries0 END AS retries,
  CASE WHEN r.unique_id IS NULL THEN m.error_msg ELSE r.error_msg END AS error_msg,
  r.ms_elapsed, r.protocol_error,
  CASE WHEN r.unique_id IS NOT NULL THEN {TS} END AS dt_processed
FROM f_message m LEFT JOIN rep r ON r.unique_id = m.unique_id
""")
def q_message_status(fx):
    s = R.message_status(_queue(fx), _replies(fx))
    return s.select(*QCOLS, "ms_elapsed", "protocol_error", "dt_processed")
