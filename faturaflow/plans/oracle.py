"""The registered queries as DuckDB SQL over the same test tables."""

from __future__ import annotations

from faturaflow.fixtures import BUYER
from faturaflow.operators.accounts import (
    PROMPT_ACCOUNTS,
    PROMPT_INTRO,
    PROMPT_MAIL,
    PROMPT_RULE,
)
from faturaflow.operators.status import NOTICE_SUBJECTS

def _gates(ids: str, answered: str = "") -> str:
    """First gate of each row of `ids` (message_id, ...), with the answers that `answered` lets through."""
    return f"""
  SELECT m.*, coalesce(mail.received_at, '') AS received_at, mail.sender, mail.subject,
    num.a, num.h, num.f, v.buy_from_no, v.vendor_no, s.n_lines, s.total,
    CASE WHEN s_rows > 1 THEN trim(ans.answer) ELSE first_account END AS account,
    try_strptime(num.f, '%Y%m%d') AS d,
    coalesce(s.n_groups, 0) AS n_groups,
    CASE WHEN mail.subject IS NULL THEN 'NOT_FOUND'
      WHEN no_sender AND NOT (mail.has_attachments AND p.payload IS NOT NULL) THEN 'EMAIL_ERROR'
      WHEN NOT mail.has_attachments THEN 'NO_ATTACHMENTS'
      WHEN p.payload IS NULL THEN 'NO_QR'
      WHEN num.b IS NULL THEN 'BAD_QR'
      WHEN num.b <> '{BUYER}' THEN 'WRONG_BUYER'
      WHEN num.a IS NULL THEN 'BAD_QR'
      WHEN v.vendor_no IS NULL THEN 'UNKNOWN_VENDOR'
      WHEN s_rows IS NULL THEN 'NO_POSTING_HISTORY'
      WHEN s_rows > 1 AND ans.answer IS NULL THEN 'AWAITING_ACCOUNT'
      WHEN s_rows > 1 AND acc.account IS NULL THEN 'NO_ACCOUNT'
      WHEN i2 IS NULL AND i3 IS NULL AND i5 IS NULL AND i7 IS NULL THEN 'NO_TAX_COLUMNS'
      WHEN (s.n_lines > 0 AND num.h IS NULL) OR (i3 = 'abc' AND i4 IS NULL) THEN 'MISSING_FIELD'
      WHEN s.n_lines IS NULL THEN 'NO_TAX_VALUES' END AS gate
  FROM {ids} m
  LEFT JOIN mail ON m.message_id = mail.message_id
  LEFT JOIN first_payload p ON m.message_id = p.message_id
  LEFT JOIN num ON p.message_id = num.message_id
  LEFT JOIN ans ON m.message_id = ans.message_id{answered}
  LEFT JOIN vdir v ON num.a = v.vat
  LEFT JOIN (SELECT vendor_no, n_rows AS s_rows, first_account FROM accsum) t ON v.vendor_no = t.vendor_no
  LEFT JOIN acc ON v.vendor_no = acc.vendor_no AND trim(ans.answer) = acc.account
  LEFT JOIN bandsum s ON num.message_id = s.message_id"""


_EARLY = " AND CAST(ans.message_id AS BIGINT) % 4 <> 1"

# Named sub-queries. Each may use the ones before it.
PARTS: dict[str, str] = {
    "sums": """
  SELECT l_orderkey, min(l_suppkey) AS supp,
    CAST(sum(CASE WHEN l_tax = 0 THEN CAST(l_extendedprice AS DECIMAL(15,2)) END) AS DECIMAL(15,2)) AS i2,
    CAST(sum(CASE WHEN l_tax > 0 AND l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END) AS DECIMAL(15,2)) AS i3,
    CAST(sum(CASE WHEN l_tax > 0 AND l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END) AS DECIMAL(15,2)) AS i5,
    CAST(sum(CASE WHEN l_tax > 0 AND l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(15,2)) END) AS DECIMAL(15,2)) AS i7
  FROM lineitem GROUP BY l_orderkey""",
    # The invoice fields as they stand in the payload; NULL where the payload has no such key.
    "inv": f"""
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS message_id, supp,
    CASE WHEN o_orderkey % 131 = 7 THEN NULL ELSE CAST(500000000 + supp AS VARCHAR) END AS a,
    CASE WHEN o_orderkey % 127 = 6 THEN NULL WHEN o_orderkey % 17 = 0 THEN '999' ELSE '{BUYER}' END AS b,
    CASE WHEN o_orderkey % 101 = 1 THEN NULL WHEN o_orderkey % 103 = 2 THEN '20241399'
      ELSE strftime(o_orderdate, '%Y%m%d') END AS f,
    CASE WHEN o_orderkey % 107 = 3 THEN NULL
      ELSE 'ATCUD-' || CAST(o_orderkey - CASE WHEN o_orderkey % 29 = 1 THEN 1 ELSE 0 END AS VARCHAR) END AS h,
    CASE WHEN o_orderkey % 109 = 4 THEN NULL WHEN o_orderkey % 113 = 5 THEN 'abc'
      WHEN o_orderkey % 137 = 8 THEN NULL ELSE CAST(i2 AS VARCHAR) END AS i2,
    CASE WHEN o_orderkey % 109 = 4 OR o_orderkey % 113 = 5 THEN NULL
      WHEN o_orderkey % 137 = 8 THEN 'abc' ELSE CAST(i3 AS VARCHAR) END AS i3,
    CASE WHEN plain THEN CAST(CAST(round(i3 * CAST(0.06 AS DECIMAL(3,2)), 2) AS DECIMAL(15,2)) AS VARCHAR) END AS i4,
    CASE WHEN plain THEN CAST(i5 AS VARCHAR) END AS i5,
    CASE WHEN plain THEN CAST(CAST(round(i5 * CAST(0.13 AS DECIMAL(3,2)), 2) AS DECIMAL(15,2)) AS VARCHAR) END AS i6,
    CASE WHEN plain THEN CAST(i7 AS VARCHAR) END AS i7,
    CASE WHEN plain THEN CAST(CAST(round(i7 * CAST(0.23 AS DECIMAL(3,2)), 2) AS DECIMAL(15,2)) AS VARCHAR) END AS i8
  FROM (SELECT *, NOT (o_orderkey % 109 = 4 OR o_orderkey % 113 = 5 OR o_orderkey % 137 = 8) AS plain
        FROM orders JOIN sums ON o_orderkey = l_orderkey)""",
    "qr": """
  SELECT *, concat_ws('*', 'A:' || a, 'B:' || b, 'D:FT', 'F:' || f, 'H:' || h, 'I1:PT', 'I2:' || i2,
    'I3:' || i3, 'I4:' || i4, 'I5:' || i5, 'I6:' || i6, 'I7:' || i7, 'I8:' || i8) || '*' AS payload
  FROM inv""",
    "first_payload": """
  SELECT message_id, arg_min(found, (l_suppkey % 2, l_linenumber % 3, l_partkey % 2, l_linenumber, l_partkey)) AS payload
  FROM (SELECT *, payload || 'Z:' || CAST(l_linenumber AS VARCHAR) || '*' AS found FROM qr JOIN lineitem ON k = l_orderkey)
  WHERE l_linenumber >= 3 AND l_partkey % 11 <> 5 AND length(found) - length(replace(found, '*', '')) >= 6
  GROUP BY message_id""",
    "vend": """
  SELECT 'V' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(6, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS vendor_no,
    CASE WHEN s_suppkey % 3 = 0 THEN lower(n) ELSE n END AS name,
    CASE WHEN s_suppkey % 10 <> 9
      THEN CAST(500000000 + s_suppkey - CASE WHEN s_suppkey % 11 = 6 THEN 1 ELSE 0 END AS VARCHAR) END AS vat
  FROM (SELECT s_suppkey, 'Supplier#' ||
          lpad(CAST(s_suppkey - CASE WHEN s_suppkey % 13 = 5 THEN 1 ELSE 0 END AS VARCHAR), 9, '0') AS n
        FROM supplier)""",
    "vdir": """
  SELECT v.vat, v.name AS vendor_name, n.vendor_no, u.buy_from_no
  FROM (SELECT vat, arg_min(name, vendor_no) AS name FROM vend WHERE vat IS NOT NULL GROUP BY vat) v
  JOIN (SELECT name, min(vendor_no) AS vendor_no FROM vend GROUP BY name) n ON v.name = n.name
  JOIN (SELECT upper(name) AS un, min(vendor_no) AS buy_from_no FROM vend WHERE vat IS NOT NULL
        GROUP BY upper(name)) u ON upper(v.name) = u.un""",
    "posted": """
  SELECT 'V' || lpad(CAST(l_suppkey - l_suppkey % 4 AS VARCHAR),
           CAST(greatest(6, length(CAST(l_suppkey - l_suppkey % 4 AS VARCHAR))) AS INTEGER), '0') AS vendor_no,
    '62' || lpad(CAST(p_size AS VARCHAR), CAST(greatest(3, length(CAST(p_size AS VARCHAR))) AS INTEGER), '0') AS account,
    p_type AS description
  FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL
  SELECT 'V' || lpad(CAST(x AS VARCHAR), CAST(greatest(6, length(CAST(x AS VARCHAR))) AS INTEGER), '0'), '62000', 'LITERAL'
  FROM (SELECT CASE WHEN s_suppkey % 4 = 1 THEN s_suppkey ELSE s_suppkey - s_suppkey % 4 END AS x FROM supplier)""",
    "acc": "SELECT vendor_no, account, count(*) AS n_lines FROM posted GROUP BY vendor_no, account",
    "accsum": """
  SELECT vendor_no, CAST(sum(n_lines) AS BIGINT) AS n_rows, count(*) AS n_accounts, min(account) AS first_account
  FROM acc GROUP BY vendor_no""",
    "ans": """
  SELECT message_id, CASE WHEN k % 5 = 0 THEN '99999' ELSE '  ' || first_account || ' ' END AS answer
  FROM qr JOIN accsum
    ON 'V' || lpad(CAST(supp AS VARCHAR), CAST(greatest(6, length(CAST(supp AS VARCHAR))) AS INTEGER), '0') = accsum.vendor_no""",
    "ph": """
  SELECT 'FCA25' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(6, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')
      AS document_no, 'ATCUD-' || CAST(o_orderkey AS VARCHAR) AS vendor_invoice_no
  FROM orders WHERE o_orderstatus = 'O'""",
    "phr": "SELECT 'ATCUD-' || CAST(o_orderkey AS VARCHAR) AS vendor_invoice_no FROM orders WHERE o_orderstatus = 'F'",
    "nextno": """
  SELECT coalesce(TRY_CAST(split_part(max(document_no), 'FCA25', 2) AS BIGINT) + 1, 1) AS next_no
  FROM ph WHERE contains(document_no, 'FCA25')""",
    "mail": """
  SELECT CAST(o_orderkey AS VARCHAR) AS message_id,
    CASE WHEN o_custkey % 21 = 0 THEN 'Unknown Sender' WHEN o_custkey % 7 = 0 OR c_name IS NULL
      THEN 'c' || CAST(o_custkey AS VARCHAR) || '@example.com' ELSE c_name END AS sender,
    o_custkey % 21 = 0 AS no_sender,
    CASE WHEN o_orderkey % 23 <> 5 THEN 'Invoice ' || CAST(o_orderkey AS VARCHAR) END AS subject,
    o_orderpriority AS body,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS received_at,
    o_orderkey % 19 NOT IN (3, 4) AS has_attachments
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "notified": """
  SELECT CAST(o_orderkey AS VARCHAR) AS message_id FROM orders
  UNION
  SELECT CASE WHEN event_type = 'error' THEN 'X' ELSE '' END || CAST(user_id AS VARCHAR) FROM events""",
    # Numbers of one payload: NULL where the text is no number.
    "num": """
  SELECT message_id, a, b, f, h, i2, i3, i4, i5, i6, i7, i8, payload,
    TRY_CAST(i2 AS DOUBLE) AS b0, TRY_CAST(i3 AS DOUBLE) AS b1, TRY_CAST(i5 AS DOUBLE) AS b2, TRY_CAST(i7 AS DOUBLE) AS b3,
    CAST(0 AS DOUBLE) AS v0,
    CASE WHEN i4 IS NULL THEN 0 ELSE TRY_CAST(i4 AS DOUBLE) END AS v1,
    CASE WHEN i6 IS NULL THEN 0 ELSE TRY_CAST(i6 AS DOUBLE) END AS v2,
    CASE WHEN i8 IS NULL THEN 0 ELSE TRY_CAST(i8 AS DOUBLE) END AS v3
  FROM qr""",
    "bands": """
  SELECT message_id, h, f, band_order, band, base, vat, base + vat AS total,
    round_even(vat / base * 100 * 100, 0) / 100 AS vat_percent
  FROM (SELECT message_id, h, f, 0 AS band_order, 'I2' AS band, b0 AS base, v0 AS vat FROM num
        UNION ALL SELECT message_id, h, f, 1, 'I3', b1, v1 FROM num
        UNION ALL SELECT message_id, h, f, 2, 'I5', b2, v2 FROM num
        UNION ALL SELECT message_id, h, f, 3, 'I7', b3, v3 FROM num)
  WHERE base > 0 AND vat IS NOT NULL""",
    "grp": """
  SELECT *, CASE WHEN vat_percent BETWEEN 22.99 AND 23.01 THEN 'OBS-NOR'
    WHEN vat_percent BETWEEN 21.99 AND 22.01 THEN 'OBS-NORMAD'
    WHEN vat_percent BETWEEN 5.99 AND 6.01 THEN 'OBS-RDZ'
    WHEN vat_percent BETWEEN -0.01 AND 0.01 THEN 'OBS-ISEN' END AS posting_group
  FROM bands""",
    "bandsum": """
  SELECT message_id, count(*) AS n_lines, count(posting_group) AS n_groups,
    coalesce(max(total) FILTER (band_order = 0), 0) + coalesce(max(total) FILTER (band_order = 1), 0)
      + coalesce(max(total) FILTER (band_order = 2), 0) + coalesce(max(total) FILTER (band_order = 3), 0) AS total
  FROM grp GROUP BY message_id""",
    "gates": _gates("notified"),
    "early_gates": _gates("notified", _EARLY),
    "screened": """
  SELECT g.*,
    CASE WHEN gate IS NOT NULL THEN gate
      WHEN h IN (SELECT vendor_invoice_no FROM ph UNION ALL SELECT vendor_invoice_no FROM phr) THEN 'DUPLICATE'
      WHEN first_sent < (received_at, g.message_id) THEN 'DUPLICATE'
      WHEN f IS NOT NULL AND d IS NULL THEN 'BAD_DATE'
      WHEN n_groups = 0 THEN 'NO_VALID_GROUP'
      WHEN f IS NULL THEN 'NO_DATE' ELSE 'SENT' END AS status
  FROM gates g LEFT JOIN (
    SELECT h AS fh, min((received_at, message_id)) AS first_sent FROM gates
    WHERE gate IS NULL AND d IS NOT NULL AND n_groups > 0 GROUP BY h) w ON g.h = w.fh""",
    "numbered": """
  SELECT *, CASE WHEN status = 'SENT' THEN 'FCA25' || lpad(CAST(n AS VARCHAR), CAST(greatest(6, length(CAST(n AS VARCHAR))) AS INTEGER), '0')
    END AS document_no
  FROM (SELECT *, (SELECT next_no FROM nextno) - 1
          + row_number() OVER (PARTITION BY status = 'SENT' ORDER BY received_at, message_id) AS n FROM screened)""",
    "linerec": """
  SELECT n.document_no, 'Invoice' AS document_type,
    10000 * row_number() OVER (PARTITION BY n.document_no ORDER BY band_order) AS line_no,
    CAST(1 AS BIGINT) AS quantity, n.account, g.base AS direct_unit_cost, g.vat AS total_vat_amount,
    g.vat_percent, g.posting_group AS vat_prod_posting_group,
    'IRSINDEP23' AS withholding_tax_code, 'G/L Account' AS type, 'G/L Account' AS filtered_type_field
  FROM numbered n JOIN grp g ON n.message_id = g.message_id WHERE n.document_no IS NOT NULL""",
    # Three landing rounds: an id is new in its first one; it may be taken up again in the second,
    # when the other answers are there.
    "landed": """
  SELECT CAST(o_orderkey AS VARCHAR) AS message_id, CAST(o_orderdate AS TIMESTAMP) AS ts FROM orders
  UNION ALL
  SELECT CASE WHEN event_type = 'error' THEN 'X' ELSE '' END || CAST(user_id AS VARCHAR), CAST(ts AS TIMESTAMP) FROM events""",
    "round_ids": """
  SELECT message_id, min(dayofyear(ts) % 3) + 1 AS round, false AS again FROM landed GROUP BY message_id
  UNION ALL
  SELECT message_id, 2, true FROM landed WHERE TRY_CAST(message_id AS BIGINT) % 4 = 1
  GROUP BY message_id HAVING min(dayofyear(ts) % 3) = 0""",
    "round_gates": _gates("round_ids", " AND (m.round > 1 OR CAST(ans.message_id AS BIGINT) % 4 <> 1)"),
    "round_taken": """
  SELECT * FROM round_gates
  WHERE NOT again OR (message_id IN (SELECT message_id FROM ans)
    AND message_id IN (SELECT message_id FROM round_gates WHERE round = 1 AND gate = 'AWAITING_ACCOUNT'))""",
    "round_screened": """
  SELECT g.*,
    CASE WHEN gate IS NOT NULL THEN gate
      WHEN h IN (SELECT vendor_invoice_no FROM ph UNION ALL SELECT vendor_invoice_no FROM phr) THEN 'DUPLICATE'
      WHEN first_sent < (round, received_at, g.message_id) THEN 'DUPLICATE'
      WHEN f IS NOT NULL AND d IS NULL THEN 'BAD_DATE'
      WHEN n_groups = 0 THEN 'NO_VALID_GROUP'
      WHEN f IS NULL THEN 'NO_DATE' ELSE 'SENT' END AS status
  FROM round_taken g LEFT JOIN (
    SELECT h AS fh, min((round, received_at, message_id)) AS first_sent FROM round_taken
    WHERE gate IS NULL AND d IS NOT NULL AND n_groups > 0 GROUP BY h) w ON g.h = w.fh""",
    "round_numbered": """
  SELECT *, CASE WHEN status = 'SENT' THEN 'FCA25' || lpad(CAST(n AS VARCHAR), CAST(greatest(6, length(CAST(n AS VARCHAR))) AS INTEGER), '0')
    END AS document_no
  FROM (SELECT *, (SELECT next_no FROM nextno) - 1
          + row_number() OVER (PARTITION BY status = 'SENT' ORDER BY round, received_at, message_id) AS n FROM round_screened)""",
    # Band records of new invoices joined to vendors by name, and the documents they make.
    "fresh": """
  SELECT g.message_id, g.h, band_order, base, g.vat, posting_group, vend.vendor_no, try_strptime(g.f, '%Y%m%d') AS d
  FROM grp g JOIN qr ON g.message_id = qr.message_id JOIN vdir ON qr.a = vdir.vat
  JOIN vend ON upper(vend.name) = upper(vdir.vendor_name)
  WHERE vend.vat IS NOT NULL AND g.h IS NOT NULL
    AND g.h NOT IN (SELECT vendor_invoice_no FROM ph UNION ALL SELECT vendor_invoice_no FROM phr)""",
    "docs": """
  SELECT *, 'FCA25' || lpad(CAST(n AS VARCHAR), CAST(greatest(6, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS document_no
  FROM (SELECT *, (SELECT next_no FROM nextno) - 1 + row_number() OVER (ORDER BY message_id) AS n
        FROM (SELECT message_id, h, min(vendor_no) AS buy_from_no, min(d) AS d,
                row_number() OVER (PARTITION BY h ORDER BY message_id) AS place
              FROM fresh GROUP BY message_id, h HAVING count(posting_group) > 0 AND min(d) IS NOT NULL)
        WHERE place = 1)""",
    "pages_in": """
  SELECT CAST(conv_id AS VARCHAR) AS message_id, turn % 2 AS att_pos,
    'conv' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn % 2 AS VARCHAR) || '.pdf' AS filename,
    turn AS page_no, text FROM conversations WHERE text IS NOT NULL""",
    "texts": """
  SELECT message_id, min(filename) AS filename, string_agg(text, '' ORDER BY page_no) AS text,
    CAST(count(*) AS VARCHAR) AS pages
  FROM pages_in GROUP BY message_id, att_pos HAVING length(string_agg(text, '')) > 0""",
    "docmail": """
  SELECT CAST(doc_id AS VARCHAR) AS message_id, lang || '@example.com' AS sender_address,
    CASE WHEN doc_id % 11 <> 0 THEN 'Document ' || CAST(doc_id AS VARCHAR) END AS subject, lang AS body,
    doc_id % 7 <> 0 AS has_attachments, source, text, lang, n_chars
  FROM documents""",
}

# All notifications land first; then the other answers, without a notification.
PARTS["answer_ids"] = """
  SELECT DISTINCT message_id, 1 AS round, false AS again FROM landed
  UNION ALL
  SELECT DISTINCT message_id, 2, true FROM landed WHERE TRY_CAST(message_id AS BIGINT) % 4 = 1"""
for _part in ("gates", "taken", "screened", "numbered"):
    PARTS[f"answer_{_part}"] = PARTS[f"round_{_part}"].replace("round_", "answer_")

_CALENDAR = "strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"

_STATUS_SUBJECT = (
    "CASE status "
    + " ".join(f"WHEN '{s}' THEN '{subject}'" for s, subject in NOTICE_SUBJECTS.items())
    + " END"
)


def _hint(problem: str) -> str:
    return (
        f"'{problem}' || chr(10) || chr(10) || 'Para encontrar este email no Outlook:' || chr(10) || "
        "'1. Na caixa de pesquisa, digite: subject:''' || subject || ''' received:' || substr(received_at, 1, 10)"
        " || chr(10) || '2. Ou pesquise por: ' || subject || chr(10) || chr(10) || 'Detalhes do Email:' || chr(10)"
        " || 'Assunto: ' || subject || chr(10) || 'Data de Recebimento: ' || received_at || chr(10)"
        " || 'Remetente: ' || sender"
    )


_FROM = "'Invoice sent by ' || coalesce(sender, 'Unknown Sender') || "
_FAILED = "'Ocorreu um erro ao processar a fatura.' || chr(10) || "
_STATUS_TEXT = f"""CASE status
    WHEN 'NOT_FOUND' THEN 'Email não encontrado ou não pode ser processado.' || chr(10) || 'ID do Email: ' || message_id
    WHEN 'EMAIL_ERROR' THEN 'Ocorreu um erro ao processar o email.' || chr(10) || 'ID do Email: ' || message_id || chr(10) || 'Erro: no sender address'
    WHEN 'NO_ATTACHMENTS' THEN {_hint("Email não contém anexos")}
    WHEN 'NO_QR' THEN {_hint("Não foi encontrado QR code nos anexos")}
    WHEN 'WRONG_BUYER' THEN {_FROM}' it is not valid because it does not match the expected NIF number'
    WHEN 'UNKNOWN_VENDOR' THEN 'Vendor ' || a || ' is not valid because it does not match the expected NIF number in our database'
    WHEN 'NO_POSTING_HISTORY' THEN {_FAILED}'Erro: no posting history'
    WHEN 'NO_ACCOUNT' THEN {_FROM}' is not valid - no valid account number found'
    WHEN 'NO_TAX_COLUMNS' THEN {_FROM}' is not valid - no tax values found'
    WHEN 'MISSING_FIELD' THEN {_FAILED}'Erro: missing field'
    WHEN 'NO_TAX_VALUES' THEN {_FROM}' is not valid - no valid tax values found'
    WHEN 'DUPLICATE' THEN {_FROM}' already exists in Navision'
    WHEN 'NO_VALID_GROUP' THEN {_FROM}' is not valid - no posting group for its VAT'
    WHEN 'NO_DATE' THEN {_FROM}' is not valid - no document date' END"""

_OUTCOMES = """SELECT message_id, received_at, status, document_no,
  CASE WHEN document_no IS NULL THEN 0 ELSE n_lines END AS n_lines,
  CASE WHEN document_no IS NOT NULL THEN total END AS total FROM numbered"""

_PROMPT_HEAD = f"'{PROMPT_INTRO}' || chr(10) || chr(10) || '{PROMPT_ACCOUNTS}' || chr(10)"
_PROMPT_TAIL = (
    f"chr(10) || chr(10) || '{PROMPT_MAIL}' || chr(10) || '- Remetente: ' || sender || chr(10) || '- Assunto: ' || "
    "coalesce(subject, '') || chr(10) || '- Conteúdo: ' || body || chr(10) || '- Anexos: ' || chr(10) || chr(10) || "
    f"'{PROMPT_RULE}'"
)

SELECTS: dict[str, str] = {
    "notification_ids": f"SELECT CAST(user_id AS VARCHAR) AS message_id, {_CALENDAR} AS ts FROM events WHERE event_type <> 'error'",
    "notification_dedup": f"""SELECT message_id, {_CALENDAR} AS first_ts FROM (
  SELECT CAST(user_id AS VARCHAR) AS message_id, min(ts) AS ts FROM events WHERE event_type <> 'error' GROUP BY user_id)""",
    "message_filter": """SELECT CAST(event_id AS VARCHAR) AS message_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS received_at
FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND event_type <> 'view' AND NOT value < 1.0""",
    "message_ingest": """SELECT message_id, '' AS internet_message_id, sender_address, sender_address AS sender, subject, body,
  has_attachments, CASE WHEN has_attachments THEN CAST(1 AS BIGINT) ELSE 0 END AS n_attachments,
  CASE WHEN subject IS NULL THEN 'NOT_FOUND' END AS status FROM docmail""",
    "attachment_decode": """SELECT message_id, CAST(0 AS BIGINT) AS att_pos, source AS name,
  CASE WHEN lang IN ('en', 'de') THEN 'application/pdf' ELSE 'text/plain' END AS content_type,
  CASE WHEN length(text) > 0 THEN CAST(strlen(text) AS BIGINT) END AS n_bytes,
  CASE WHEN length(text) > 0 THEN md5(text) END AS content_md5, n_chars AS size,
  lang IN ('en', 'de') AND strlen(text) > 0 AS is_pdf
FROM docmail WHERE has_attachments OR length(text) = 0""",
    "attachment_fetch": """SELECT 'm' || CAST(d.doc_id AS VARCHAR) AS message_id,
  CASE WHEN d.doc_id % 5 <> 0 THEN source ELSE 'arquivo_desconhecido' END AS filename,
  CASE WHEN d.doc_id % 3 <> 0 THEN 'application/pdf' ELSE 'application/octet-stream' END AS content_type,
  CAST(strlen(text) AS BIGINT) AS n_bytes, md5(text) AS content_md5
FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE toxic = 0 AND strlen(text) > 0""",
    "qr_accept_first": "SELECT message_id, payload FROM first_payload",
    "qr_parse": """SELECT message_id, a AS issuer_nif, b AS payload_buyer, 'FT' AS doc_type, f AS issue_date, h AS vendor_invoice_no,
  'PT' AS region, i2, i3, i4, i5, i6, i7, i8,
  CAST(length(payload) - length(replace(payload, '*', '')) AS BIGINT) AS n_fields,
  array_to_string(list_sort(list_filter([a, b, 'FT', f, h, 'PT', i2, i3, i4, i5, i6, i7, i8], lambda x: x IS NOT NULL)), ' ') AS all_values
FROM qr""",
    "pdf_text_assembly": """SELECT i.message_id, coalesce(filename, 'No text') AS filename, coalesce(text, '') AS text,
  coalesce(pages, '0') AS pages
FROM (SELECT CAST(c_custkey AS VARCHAR) AS message_id FROM customer UNION
      SELECT CAST(conv_id AS VARCHAR) FROM conversations) i LEFT JOIN texts t ON i.message_id = t.message_id""",
    "pdf_text_blocks": """SELECT message_id, CAST(att_pos AS BIGINT) AS att_pos, page_no // 2 AS block_no,
  string_agg(text, '' ORDER BY page_no) AS text, count(*) AS pages
FROM pages_in GROUP BY message_id, att_pos, page_no // 2""",
    "response_assembly": """SELECT m.message_id, subject, received_at, payload, coalesce(filename, 'No text') AS filename,
  coalesce(text, '') AS text, coalesce(pages, '0') AS pages
FROM mail m JOIN first_payload p ON m.message_id = p.message_id LEFT JOIN texts t ON m.message_id = t.message_id
WHERE subject IS NOT NULL AND has_attachments""",
    "buyer_check": f"""SELECT message_id, b AS payload_buyer, a AS issuer_nif,
  CASE WHEN b IS NULL THEN 'BAD_QR' WHEN b <> '{BUYER}' THEN 'WRONG_BUYER' WHEN a IS NULL THEN 'BAD_QR' END AS status FROM qr""",
    "vendor_lookup": f"""SELECT message_id, a AS issuer_nif, vendor_name, vendor_no, buy_from_no,
  CASE WHEN b IS NULL THEN 'BAD_QR' WHEN b <> '{BUYER}' THEN 'WRONG_BUYER' WHEN a IS NULL THEN 'BAD_QR'
    WHEN vendor_no IS NULL THEN 'UNKNOWN_VENDOR' END AS status
FROM qr LEFT JOIN vdir ON a = vat""",
    "vendor_accounts": """SELECT acc.vendor_no, account, n_lines, n_rows, n_accounts
FROM acc JOIN accsum ON acc.vendor_no = accsum.vendor_no""",
    "account_resolution": f"""SELECT qr.message_id, v.vendor_no, n_rows, answer,
  CASE WHEN n_rows > 1 THEN acc.account ELSE first_account END AS account,
  CASE WHEN b IS NULL THEN 'BAD_QR' WHEN b <> '{BUYER}' THEN 'WRONG_BUYER' WHEN a IS NULL THEN 'BAD_QR'
    WHEN v.vendor_no IS NULL THEN 'UNKNOWN_VENDOR' WHEN n_rows IS NULL THEN 'NO_POSTING_HISTORY'
    WHEN n_rows > 1 AND answer IS NULL THEN 'AWAITING_ACCOUNT'
    WHEN n_rows > 1 AND acc.account IS NULL THEN 'NO_ACCOUNT' END AS status
FROM qr LEFT JOIN vdir v ON a = vat LEFT JOIN accsum s ON v.vendor_no = s.vendor_no
LEFT JOIN ans ON qr.message_id = ans.message_id
LEFT JOIN acc ON v.vendor_no = acc.vendor_no AND trim(answer) = acc.account""",
    "classification_requests": f"""SELECT qr.message_id, v.vendor_no, 'gpt-4' AS model, CAST(10 AS INTEGER) AS max_tokens,
  {_PROMPT_HEAD} || listing || {_PROMPT_TAIL} AS prompt
FROM qr JOIN vdir v ON a = vat JOIN accsum s ON v.vendor_no = s.vendor_no
JOIN (SELECT vendor_no, string_agg(entry, chr(10) ORDER BY entry) AS listing
      FROM (SELECT DISTINCT vendor_no, account || ' ' || description AS entry FROM posted) GROUP BY vendor_no) l
  ON v.vendor_no = l.vendor_no
JOIN mail m ON qr.message_id = m.message_id
WHERE b = '{BUYER}' AND n_rows > 1""",
    "erp_tables": """SELECT 'vendors' AS erp_table, vendor_no AS "first", name AS "second", vat AS third FROM vend
UNION ALL SELECT 'purchase_header', document_no, vendor_invoice_no, NULL FROM ph
UNION ALL SELECT 'purchase_header_reg', NULL, vendor_invoice_no, NULL FROM phr
UNION ALL SELECT 'posted_lines', vendor_no, account, description FROM posted""",
    "run_requests": f"""SELECT n.message_id, n.vendor_no, 'gpt-4' AS model, CAST(10 AS INTEGER) AS max_tokens,
  {_PROMPT_HEAD} || listing || {_PROMPT_TAIL} AS prompt
FROM (SELECT message_id, vendor_no FROM early_gates WHERE gate = 'AWAITING_ACCOUNT') n
JOIN mail m ON n.message_id = m.message_id
JOIN (SELECT vendor_no, string_agg(entry, chr(10) ORDER BY entry) AS listing
      FROM (SELECT DISTINCT vendor_no, account || ' ' || description AS entry FROM posted) GROUP BY vendor_no) l
  ON n.vendor_no = l.vendor_no""",
    "tax_bands": """SELECT g.message_id, g.h AS vendor_invoice_no, 'FT' AS doc_type, coalesce(g.f, '') AS issue_date,
  'Registrada' AS situation, 'PT' AS issuer_region, '' AS buyer_region, band, base, vat, total, vat_percent, posting_group
FROM grp g WHERE g.h IS NOT NULL""",
    "vendor_name_join": """SELECT message_id, d.vendor_name, vend.vendor_no, vend.vat
FROM qr JOIN vdir d ON a = d.vat JOIN vend ON upper(d.vendor_name) = upper(vend.name) WHERE vend.vat IS NOT NULL""",
    "new_invoices": """SELECT message_id, h AS vendor_invoice_no FROM qr
WHERE NOT EXISTS (SELECT 1 FROM ph WHERE ph.vendor_invoice_no = h)
  AND NOT EXISTS (SELECT 1 FROM phr WHERE phr.vendor_invoice_no = h)""",
    "next_invoice_number": "SELECT next_no FROM nextno",
    "invoice_numbering": """SELECT message_id, n AS number,
  'FCA25' || lpad(CAST(n AS VARCHAR), CAST(greatest(6, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS document_no
FROM (SELECT message_id, (SELECT next_no FROM nextno) - 1
        + row_number() OVER (ORDER BY coalesce(f, ''), message_id) AS n FROM qr)""",
    "record_headers": """SELECT document_no, 'Invoice' AS document_type, buy_from_no AS buy_from_vendor_no,
  strftime(d, '%Y-%m-%d') AS document_date, h AS vendor_invoice_no FROM docs""",
    "record_lines": """SELECT document_no,
  10000 * row_number() OVER (PARTITION BY document_no ORDER BY band_order, vendor_no) AS line_no, '62000' AS account,
  base AS direct_unit_cost, vat AS total_vat_amount, posting_group AS vat_prod_posting_group
FROM fresh JOIN docs ON fresh.message_id = docs.message_id""",
    "headers": """SELECT document_no, 'Invoice' AS document_type, buy_from_no AS buy_from_vendor_no,
  strftime(d, '%Y-%m-%d') AS document_date, h AS vendor_invoice_no FROM numbered WHERE document_no IS NOT NULL""",
    "lines": "SELECT * FROM linerec",
    "valid_documents": """SELECT message_id AS document_no, CAST(band_order AS BIGINT) AS band_order,
  posting_group AS vat_prod_posting_group
FROM (SELECT *, bool_or(posting_group IS NOT NULL) OVER (PARTITION BY message_id) AS valid FROM grp) WHERE valid""",
    "line_numbers": """SELECT message_id AS document_no, CAST(band_order AS BIGINT) AS band_order,
  10000 * row_number() OVER (PARTITION BY message_id ORDER BY band_order) AS line_no FROM grp""",
    "header_line_match": """SELECT document_no, n_lines, CASE WHEN n_lines = 0 THEN 'NO_LINES' END AS status
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS document_no, count(g.message_id) AS n_lines
      FROM orders LEFT JOIN grp g ON g.message_id = CAST(o_orderkey AS VARCHAR) GROUP BY o_orderkey)""",
    "header_payloads": """SELECT document_no, 'Invoice' AS document_type, document_no AS no, buy_from_no AS buy_from_vendor_no,
  strftime(d, '%Y-%m-%d') AS document_date, h AS vendor_invoice_no FROM numbered WHERE document_no IS NOT NULL""",
    "line_payloads": """SELECT document_type, document_no, type, filtered_type_field AS filteredtypefield, account AS no,
  vat_prod_posting_group, CAST(NULL AS VARCHAR) AS withholding_tax_code, line_no, CAST(quantity AS DOUBLE) AS quantity,
  direct_unit_cost, nullif(total_vat_amount, 0) AS total_vat_amount FROM linerec""",
    "narrow_line_payloads": """SELECT document_type, document_no, line_no, CAST(quantity AS DOUBLE) AS quantity, direct_unit_cost,
  nullif(total_vat_amount, 0) AS total_vat_amount,
  CASE WHEN total_vat_amount = 0 THEN CAST(5 AS BIGINT) ELSE 6 END AS n_entries FROM linerec""",
    "prefixed_line_payloads": """SELECT document_no, no, vat_prod_posting_group, withholding_tax_code,
  line_no, direct_unit_cost, total_vat_amount,
  CAST(8 + CASE WHEN total_vat_amount IS NULL THEN 0 ELSE 1 END + CASE WHEN vat_prod_posting_group IS NULL THEN 0 ELSE 1 END
    + CASE WHEN withholding_tax_code IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_entries
FROM (SELECT CASE WHEN l_returnflag = 'N' THEN 'F' ELSE 'P' END || CAST(l_orderkey AS VARCHAR) AS document_no,
        CAST(l_partkey AS VARCHAR) AS no, CASE WHEN l_tax = 0 THEN 'OBS-ISEN' END AS vat_prod_posting_group,
        CASE WHEN l_linestatus = 'O' AND l_returnflag <> 'N' THEN 'IRSINDEP23' END AS withholding_tax_code,
        CAST(l_linenumber * 10000 AS BIGINT) AS line_no, CAST(l_extendedprice AS DOUBLE) AS direct_unit_cost,
        nullif(CAST(l_tax AS DOUBLE), 0) AS total_vat_amount FROM lineitem)""",
    "reject_notices": f"""SELECT message_id, status, substr(received_at, 1, 10) AS received_date,
  coalesce(sender, 'Unknown Sender') AS sender, {_STATUS_SUBJECT} AS notice_subject, {_STATUS_TEXT} AS notice_text
FROM numbered WHERE status NOT IN ('SENT', 'AWAITING_ACCOUNT')""",
    "notice_envelope": """SELECT c_custkey,
  CASE WHEN c_custkey % 5 <> 0 THEN c_name || '@example.com' END AS recipient,
  CASE WHEN c_custkey % 5 = 2 THEN lower(c_mktsegment) WHEN c_custkey % 5 > 2 THEN 'a@x;b@x' END AS cc,
  c_custkey % 5 <> 0 AS sendable FROM customer""",
    "message_outcomes": _OUTCOMES,
    "outcome_summary": "SELECT status, count(*) AS n_messages FROM numbered GROUP BY status",
    "stream_outcomes": _OUTCOMES,
    "swept_notifications": """SELECT CAST(user_id AS VARCHAR) AS message_id, count(*) AS n_events
FROM events WHERE event_type <> 'error' GROUP BY user_id""",
    "exported_messages": """SELECT message_id, subject, received_at, has_attachments FROM mail
WHERE message_id IN (SELECT message_id FROM landed) AND CAST(message_id AS BIGINT) % 7 = 0""",
    "erp_key_ranges": """SELECT vendor_no, count(*) AS n_lines, CAST(1 AS BIGINT) AS n_ranges FROM posted GROUP BY vendor_no""",
    "maintained_directories": """SELECT vdir.vat, vendor_name, vdir.vendor_no, buy_from_no, n_rows, n_accounts, first_account
FROM vdir LEFT JOIN accsum ON vdir.vendor_no = accsum.vendor_no WHERE vat IN (SELECT a FROM qr)""",
    "stream_answers": """SELECT message_id, row_number() OVER (PARTITION BY message_id ORDER BY round) AS turn, received_at, status,
  document_no, CASE WHEN document_no IS NOT NULL THEN total END AS total FROM answer_numbered""",
    "stream_rounds": """SELECT n.message_id, turn, received_at, status, document_no, n.total,
  CASE WHEN document_no IS NOT NULL THEN buy_from_no END AS buy_from_vendor_no,
  CASE WHEN document_no IS NOT NULL THEN strftime(d, '%Y-%m-%d') END AS document_date,
  CASE WHEN document_no IS NOT NULL THEN n.h END AS vendor_invoice_no,
  CASE WHEN document_no IS NOT NULL
    THEN 10000 * row_number() OVER (PARTITION BY document_no ORDER BY band_order) END AS line_no,
  CASE WHEN document_no IS NOT NULL THEN n.account END AS account,
  g.base AS direct_unit_cost, g.vat AS total_vat_amount, g.posting_group AS vat_prod_posting_group
FROM (SELECT message_id, row_number() OVER (PARTITION BY message_id ORDER BY round) AS turn, received_at, status,
        document_no, CASE WHEN document_no IS NOT NULL THEN total END AS total, buy_from_no, d, h, account
      FROM round_numbered) n LEFT JOIN grp g ON n.message_id = g.message_id AND document_no IS NOT NULL""",
}


def sql(name: str) -> str:
    """The query with the sub-queries it uses, directly or through others."""
    body = SELECTS[name]
    used: list[str] = []
    text = body
    for part in reversed(PARTS):
        if _mentions(text, part):
            used.append(part)
            text += "\n" + PARTS[part]
    ctes = ",\n".join(f"{p} AS ({PARTS[p]})" for p in reversed(used))
    return f"WITH {ctes}\n{body}" if ctes else body


def _mentions(text: str, part: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split()
    return part in words


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in SELECTS}
