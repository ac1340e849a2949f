"""Queries of the validators and protection jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.functions import validators as V
from kiln.operators import protection as P
from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources.tables import read

# Reference times for the log windows.
RETENTION_AS_OF = "2024-04-15 00:00:00"
FILENAME_AS_OF = "2024-01-01 00:00:00"
# Passphrase and salt of the column-encryption round trip (test values).
PASSPHRASE = "kiln-demo-passphrase"
SALT = b"kiln-demo-salt-0"


def _sq(p: str) -> str:
    """Pattern as an SQL string literal."""
    return "'" + p.replace("'", "''") + "'"


def _any(col: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({col}, {_sq(p)})" for p in patterns) + ")"


@query(
    "v1_email_check",
    sql=f"""
WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, {_sq(P.EMAIL_CANDIDATE)})) AS candidate FROM documents)
SELECT doc_id, candidate, regexp_matches(candidate, {_sq(V.EMAIL_PATTERN)}) AS valid FROM c""",
)
def v1_email_check(spark, sf_dir):
    return P.email_check(read(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "v2_phone_check",
    sql=f"""
WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, {_sq(P.PHONE_CANDIDATE)})) AS candidate FROM documents)
SELECT doc_id, candidate, regexp_matches(candidate, {_sq(V.PHONE_PATTERN)}) AS valid FROM c""",
)
def v2_phone_check(spark, sf_dir):
    return P.phone_check(read(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "v3_url_check",
    sql=f"SELECT page_id, url, regexp_matches(url, {_sq(V.URL_PATTERN)}) AS valid FROM pages",
)
def v3_url_check(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", "url", V.is_url(F.col("url")).alias("valid"))


@query(
    "v4_sql_injection_documents",
    sql=f"SELECT doc_id, {_any('text', V.SQLI_PATTERNS)} AS sql_injection, {_any('text', V.XSS_PATTERNS)} AS xss FROM documents",
)
def v4_sql_injection_documents(spark, sf_dir):
    return P.injection_scan(read(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "v5_xss_pages",
    sql=f"SELECT page_id, {_any('html', V.SQLI_PATTERNS)} AS sql_injection, {_any('html', V.XSS_PATTERNS)} AS xss FROM pages",
)
def v5_xss_pages(spark, sf_dir):
    return P.injection_scan(read(spark, sf_dir, "pages"), "page_id", "html")


def _sanitise_sql(c: str) -> str:
    for pattern, to in V.html_steps():
        marks = "".join(f"' || chr({ord(x)}) || '" if x < " " else x for x in to)
        c = f"regexp_replace({c}, {_sq(pattern)}, '{marks}', 'g')"
    return c


@query("v6_sanitise_html", sql=f"SELECT page_id, {_sanitise_sql('html')} AS clean_html FROM pages")
def v6_sanitise_html(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", V.sanitise_html(F.col("html")).alias("clean_html"))


@query(
    "v7_sanitise_filename",
    sql=f"""
WITH b AS (SELECT page_id, url, regexp_replace(regexp_extract(url, '([^/]*)$', 1), {_sq(r'[^\pL\pN_.\-]')}, '_', 'g') AS f FROM pages)
SELECT page_id, url, CASE WHEN length(f) = 0 OR length(f) > 255 THEN 'file_20240101_000000' ELSE f END AS file_name FROM b""",
)
def v7_sanitise_filename(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    as_of = F.lit(FILENAME_AS_OF).cast("timestamp")
    return p.select("page_id", "url", V.sanitise_filename(F.col("url"), as_of).alias("file_name"))


def _secret_sql() -> str:
    specials = "".join("\\" + ch for ch in V.CONFIG_SPECIALS)
    s = "candidate"
    return f"""
WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, {_sq(P.SECRET_CANDIDATE)}, 1)) AS candidate FROM documents)
SELECT doc_id, candidate,
       length({s}) >= 32 AND NOT regexp_matches({s}, '^[\\pL\\pN]+$') AS strong_secret,
       length({s}) >= 12 AS pw_length, regexp_matches({s}, '[A-Z]') AS pw_upper, regexp_matches({s}, '[a-z]') AS pw_lower,
       regexp_matches({s}, '\\p{{Nd}}') AS pw_digit, regexp_matches({s}, '[^\\pL\\pN_]') AS pw_special,
       regexp_matches({s}, '\\p{{Lu}}') AS cfg_upper, regexp_matches({s}, '\\p{{Ll}}') AS cfg_lower,
       regexp_matches({s}, {_sq('[' + specials + ']')}) AS cfg_special
FROM c"""


@query("v8_v9_secret_strength", sql=_secret_sql())
def v8_v9_secret_strength(spark, sf_dir):
    """Secrets assigned in documents, with the secret rule and both
    password rule sets (flattened)."""
    s = P.secret_check(read(spark, sf_dir, "documents"), "doc_id", "text")
    return s.select(
        "doc_id", "candidate", "strong_secret",
        *[F.col(f"password.{k}").alias(f"pw_{k}") for k in ("length", "upper", "lower", "digit", "special")],
        *[F.col(f"password_config.{k}").alias(f"cfg_{k}") for k in ("upper", "lower", "special")],
    )


@query(
    "v10_key_presence",
    sql="""
SELECT 'k' AS key, count(*) FILTER (WHERE coalesce(json_extract_string(props, '$.k'), '') <> '') AS rows_present,
       count(*) FILTER (WHERE coalesce(json_extract_string(props, '$.k'), '') <> '') = count(*) AS present FROM events
UNION ALL
SELECT 'user', count(*) FILTER (WHERE coalesce(json_extract_string(props, '$.user'), '') <> ''),
       count(*) FILTER (WHERE coalesce(json_extract_string(props, '$.user'), '') <> '') = count(*) FROM events""",
)
def v10_key_presence(spark, sf_dir):
    return P.key_presence(read(spark, sf_dir, "events"), "props", ["k", "user"])


@query(
    "v11_encryption_roundtrip",
    sql="""
SELECT doc_id, true AS roundtrip_ok, CASE WHEN text IS NOT NULL THEN true END AS hidden,
       CASE WHEN text IS NOT NULL THEN true END AS change_found
FROM documents""",
)
def v11_encryption_roundtrip(spark, sf_dir):
    """Encrypt every whole document text with AES-GCM under a stored key and decrypt it
    back; a token whose first letter is changed is not accepted."""
    path = scratch_path(spark, f"key-{uuid.uuid4().hex}")
    P.store_key(spark, P.derive_key(PASSPHRASE, SALT), path)
    key = P.stored_key(spark, path)
    token = F.col("token")
    first = F.when(token.startswith("A"), "B").otherwise("A")
    changed = F.concat(first, F.substring(token, 2, 2**31 - 1))
    enc = read(spark, sf_dir, "documents").select("doc_id", "text", P.encrypt_column(F.col("text"), key).alias("token"))
    return enc.select(
        "doc_id",
        F.equal_null(P.decrypt_column(token, key), F.col("text")).alias("roundtrip_ok"),
        (token != F.col("text")).alias("hidden"),
        F.when(token.isNotNull(), P.decrypt_column(changed, key, strict=False).isNull()).alias("change_found"),
    )


@query(
    "v12_lockout",
    sql="""
WITH RECURSIVE e AS (
  SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type IN ('error', 'signup')),
s AS (
  SELECT user_id, rn, event_id, ts, outcome,
         outcome AS status,
         CASE WHEN outcome = 'success' THEN 0 ELSE 1 END AS failed_attempts,
         CASE WHEN outcome = 'failure' AND 1 >= 5 THEN ts + INTERVAL 15 MINUTE END AS locked_until
  FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.event_id, e.ts, e.outcome,
         CASE WHEN s.locked_until IS NOT NULL AND s.locked_until > e.ts THEN 'rejected' ELSE e.outcome END,
         CASE WHEN s.locked_until IS NOT NULL AND s.locked_until > e.ts THEN s.failed_attempts
              WHEN e.outcome = 'success' THEN 0 ELSE s.failed_attempts + 1 END,
         CASE WHEN s.locked_until IS NOT NULL AND s.locked_until > e.ts THEN s.locked_until
              WHEN e.outcome = 'success' THEN NULL
              WHEN s.failed_attempts + 1 >= 5 THEN e.ts + INTERVAL 15 MINUTE
              ELSE s.locked_until END
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1)
SELECT user_id, event_id, ts, outcome, status, CAST(failed_attempts AS BIGINT) AS failed_attempts, locked_until FROM s""",
)
def v12_lockout(spark, sf_dir):
    """Account lockout replayed over the event log (error = failed login,
    signup = successful login)."""
    return P.lockout(P.login_attempts(read(spark, sf_dir, "events")))


@query(
    "s19_audit_events",
    sql="""
SELECT event_type, user_id, CAST(NULL AS VARCHAR) AS ip_address,
       '{"event_id":' || CAST(event_id AS VARCHAR) || ',"value":' || CAST(value AS VARCHAR)
         || ',"props":{"k":"' || json_extract_string(props, '$.k') || '"}}' AS details,
       ts AS created_at
FROM events""",
)
def s19_audit_events(spark, sf_dir):
    return P.audit_events(read(spark, sf_dir, "events"))


@query(
    "p21_recent_errors",
    sql="""
SELECT * FROM events WHERE event_type = 'error'
  AND ts >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AND ts <= (SELECT max(ts) FROM events)""",
)
def p21_recent_errors(spark, sf_dir):
    """Error events of the last hour of the log ("now" = its latest entry)."""
    e = read(spark, sf_dir, "events")
    now = e.select(F.max("ts")).first()[0]  # one value: as a literal the bound reaches the scan
    return P.recent_errors(e, F.lit(now).cast(e.schema["ts"].dataType))


@query(
    "p22_retention",
    sql=f"SELECT * FROM events WHERE ts >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 90 DAY",
)
def p22_retention(spark, sf_dir):
    return P.retain(read(spark, sf_dir, "events"), F.lit(RETENTION_AS_OF).cast("timestamp"))


@query(
    "p24_json_fields",
    sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       '{"user_id":' || CAST(user_id AS VARCHAR) || ',"event_type":"' || event_type || '"}' AS as_json
FROM events""",
)
def p24_json_fields(spark, sf_dir):
    """JSON text -> record (``from_json``) and record -> JSON text (``to_json``)."""
    e = read(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(F.struct("user_id", "event_type")).alias("as_json"),
    )


@query(
    "j7_role_overlap",
    sql="""
SELECT conv_id, list_sort(list(DISTINCT role)) AS roles FROM conversations
GROUP BY conv_id HAVING list_has_any(list(DISTINCT role), ['system'])""",
)
def j7_role_overlap(spark, sf_dir):
    """Conversations in which a system role takes part."""
    return P.roles_overlap(read(spark, sf_dir, "conversations"), "conv_id", "role", ["system"])
