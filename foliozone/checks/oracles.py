"""For each query the SQL that must give the same rows, written for DuckDB.

Where a query renders text and reads it back, the SQL states the truth the text was rendered
from instead of parsing it again.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

BOUNDS = """
bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) + 1 AS b FROM orders),
bodies AS (SELECT DISTINCT lower(o_orderstatus) AS body_code FROM orders),
ranked AS (SELECT body_code, row_number() OVER (ORDER BY body_code) - 1 AS place, count(*) OVER () AS n FROM bodies)
"""

RECORDS = f"""
{BOUNDS},
records AS (
  SELECT o_orderkey AS item_seq, concat('ORD - ', o_custkey) AS identifier, lower(o_orderstatus) AS body_code,
         CAST(o_orderdate AS DATE) AS decision_date, strftime(o_orderdate, '%Y-%m') AS partition_date,
         concat('https://example.test/en/cases/', o_orderkey, '/ord-', o_custkey, '.html') AS document_url,
         date_diff('month', a, CAST(o_orderdate AS DATE)) * n + place AS cell_seq,
         o_totalprice < 20000 AS failed, o_orderpriority
  FROM orders, bounds, ranked WHERE ranked.body_code = lower(o_orderstatus))
"""


def _windows(first: str, step: str, start: str = "a", end: str = "b", source: str = "bounds") -> str:
    return f"""
firsts AS (SELECT unnest(generate_series(CAST({first} AS TIMESTAMP), CAST({end} - 1 AS TIMESTAMP), INTERVAL {step})) AS f,
           {start} AS a, {end} AS b FROM {source}),
wins AS (SELECT greatest(CAST(f AS DATE), a) AS window_start, least(CAST(f + INTERVAL {step} AS DATE), b) AS window_end,
         row_number() OVER (ORDER BY f) - 1 AS window_seq FROM firsts)
"""


def _plan(first: str, step: str, label: str) -> str:
    return f"""WITH {BOUNDS}, {_windows(first, step)}
SELECT window_seq, window_start, window_end, strftime(window_start, '{label}') AS label, window_end - 1 AS last_day FROM wins"""


MONTHLY = _windows("date_trunc('month', a)", "1 MONTH")

ORACLES["plan_monthly"] = _plan("date_trunc('month', a)", "1 MONTH", "%Y-%m")
ORACLES["plan_weekly"] = _plan("a", "7 DAY", "%G-W%V")
ORACLES["plan_daily"] = _plan("a", "1 DAY", "%Y-%m-%d")

ORACLES["plan_single_window"] = """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT d, d + 1 AS daily_end, strftime(d, '%Y-%m-%d') AS daily_label,
       d + 7 AS weekly_end, strftime(d, '%G-W%V') AS weekly_label,
       CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS monthly_end, strftime(d, '%Y-%m') AS monthly_label
FROM d"""

ORACLES["assign_period"] = f"""
WITH {BOUNDS}, ragged AS (SELECT a + 17 AS a, b - 5 AS b FROM bounds),
{_windows("date_trunc('month', a)", "1 MONTH", source="ragged").replace("firsts", "mf").replace("wins", "months")},
{_windows("a", "7 DAY", source="ragged").replace("firsts", "wf").replace("wins", "weeks")}
SELECT o_orderkey, strftime(m.window_start, '%Y-%m') AS month_label, m.window_start AS month_start, m.window_end AS month_end,
       strftime(w.window_start, '%G-W%V') AS week_label, w.window_start AS week_start, w.window_end AS week_end
FROM orders
LEFT JOIN months m ON CAST(o_orderdate AS DATE) >= m.window_start AND CAST(o_orderdate AS DATE) < m.window_end
LEFT JOIN weeks w ON CAST(o_orderdate AS DATE) >= w.window_start AND CAST(o_orderdate AS DATE) < w.window_end"""

ORACLES["events_per_period"] = """
SELECT CASE WHEN ts >= DATE '2024-01-01' AND ts < DATE '2025-01-01' THEN strftime(ts, '%Y-%m-%d') END AS label,
       event_type, count(*) AS events FROM events GROUP BY 1, 2"""

ORACLES["cell_grid"] = f"""
WITH {BOUNDS}, {_windows("a", "7 DAY")}
SELECT window_seq * n + place AS cell_seq, window_start, window_end, strftime(window_start, '%G-W%V') AS label,
       body_code, concat('Body ', body_code) AS body_name, CAST(100 + place AS VARCHAR) AS external_id
FROM wins, ranked"""

_COVERAGE = f"""
{RECORDS}, {MONTHLY},
grid AS (SELECT window_seq * n + place AS cell_seq, window_start, window_end,
                strftime(window_start, '%Y-%m') AS label, body_code, 100 + place AS external_id FROM wins, ranked),
held AS (SELECT partition_date, body_code, count(*) AS c FROM records GROUP BY ALL),
covered AS (SELECT grid.*, coalesce(c, 0) AS records FROM grid
            LEFT JOIN held ON held.partition_date = grid.label AND held.body_code = grid.body_code)
"""

ORACLES["coverage_grid"] = f"WITH {_COVERAGE} SELECT cell_seq, label, body_code, records FROM covered"

ORACLES["missing_cells"] = f"""
WITH {RECORDS}, longer AS (SELECT CAST(a - INTERVAL 3 MONTH AS DATE) AS a, CAST(b + INTERVAL 3 MONTH AS DATE) AS b FROM bounds),
{_windows("date_trunc('month', a)", "1 MONTH", source="longer")},
grid AS (SELECT window_seq * n + place AS cell_seq, strftime(window_start, '%Y-%m') AS label, body_code FROM wins, ranked)
SELECT * FROM grid WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.partition_date = label AND r.body_code = grid.body_code)"""

ORACLES["backfill_grid"] = f"""
WITH {RECORDS}, origin AS (SELECT DATE '2015-01-04' AS a, b + 7305 AS b FROM bounds),
{_windows("a", "7 DAY", source="origin")},
complete AS (SELECT window_seq, window_start FROM wins, origin WHERE window_start + 7 <= origin.b),
held AS (SELECT decision_date + 7305 - CAST(dayofweek(decision_date + 7305) AS INTEGER) AS sunday, body_code, count(*) AS c
         FROM records GROUP BY ALL)
SELECT window_seq * n + place AS cell_seq, window_start, strftime(window_start, '%G-W%V') AS label, ranked.body_code,
       coalesce(c, 0) AS records
FROM complete CROSS JOIN ranked LEFT JOIN held ON sunday = window_start AND held.body_code = ranked.body_code"""

ORACLES["request_frontier"] = f"""
WITH {_COVERAGE}
SELECT cell_seq, CAST(page AS INTEGER) AS page_number,
       concat('https://example.test/en/search/?decisions=1&from=', strftime(window_start, '%d/%m/%Y'), '&to=',
              strftime(window_end - 1, '%d/%m/%Y'), '&legislationsub=&body=', external_id, '&pageNumber=', page) AS url
FROM (SELECT *, unnest(generate_series(1, (records + 9) // 10 + 1)) AS page FROM covered)"""

ORACLES["date_parse"] = r"""
WITH t AS (SELECT o_orderkey, o_orderkey % 7 AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
p AS (SELECT o_orderkey, CASE k
    WHEN 0 THEN strftime(d, '%d/%m/%Y') WHEN 1 THEN strftime(d, '%Y-%m-%d') WHEN 2 THEN strftime(d, '%d-%m-%Y')
    WHEN 3 THEN concat(chr(160), chr(9), strftime(d, '%-d/%-m/%Y'), ' ', chr(10))
    WHEN 4 THEN strftime(d, '%Y/%m/%d') WHEN 5 THEN concat('31/02/', strftime(d, '%Y'))
    ELSE concat(strftime(d, '%d/%m/%Y'), 'x') END AS raw,
  CASE WHEN k < 4 THEN d END AS parsed FROM t)
SELECT o_orderkey, raw, parsed, strftime(parsed, '%d/%m/%Y') AS site_date, parsed AS round_trip FROM p"""

ORACLES["text_normalise"] = rf"""
WITH r AS (SELECT doc_id, concat(chr(8195), ' ', chr(28),
    replace(replace(text, '. ', concat('. ', chr(9), chr(12))), ', ', concat(',', repeat(chr(10), 4), chr(160))),
    chr(160), chr(10)) AS t FROM documents)
SELECT doc_id,
  md5(regexp_replace(regexp_replace(t, '[ \t\r\f\v]+', ' ', 'g'), '^{SPACE}+|{SPACE}+$', '', 'g')) AS collapsed,
  md5(regexp_replace(t, '\n{{3,}}', chr(10) || chr(10), 'g')) AS fewer_blank_lines,
  md5(trim(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '-')) AS slug,
  md5(regexp_replace(t, '{SPACE}+', '', 'g')) AS without_space
FROM r"""

PAGES = """
pagebody AS (SELECT page_id, url, html, regexp_extract(url, 'https?://[^/]+/([a-z]+)/', 1) AS body_code,
                    concat('PAGE ', page_id) AS identifier, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS d FROM pages),
pagebodies AS (SELECT body_code, row_number() OVER (ORDER BY body_code) - 1 AS place, count(*) OVER () AS n
               FROM (SELECT DISTINCT body_code FROM pagebody))
"""

ORACLES["object_keys"] = f"""
WITH {PAGES},
t AS (SELECT *, strftime(d, '%Y-%m') AS label, regexp_extract(url, '[^/]*$') AS tail,
             CASE WHEN page_id % 3 = 0 THEN ' Application/PDF ; q=1' ELSE '' END AS served FROM pagebody),
u AS (SELECT *, split_part(tail, '?', 1) AS cut,
             CASE WHEN contains(tail, '.') THEN lower(regexp_extract(url, '[^.]*$')) ELSE '' END AS ext FROM t),
v AS (SELECT *, CASE ext WHEN 'pdf' THEN 'application/pdf' WHEN 'doc' THEN 'application/msword' WHEN 'rtf' THEN 'application/rtf'
                WHEN 'docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
                ELSE 'text/html' END AS guessed,
             CASE WHEN contains(cut, '.') THEN cut ELSE concat(replace(identifier, ' ', ''), '.html') END AS filename,
             CASE WHEN ext = '' THEN 'html' ELSE ext END AS url_extension FROM u),
w AS (SELECT *, CASE WHEN served = '' THEN guessed ELSE served END AS content_type,
             concat('example/', body_code, '/', label, '/', filename) AS landing_key FROM v),
x AS (SELECT *, CASE WHEN page_id % 3 = 0 THEN 'pdf' ELSE
         CASE guessed WHEN 'application/pdf' THEN 'pdf' WHEN 'application/msword' THEN 'doc' WHEN 'application/rtf' THEN 'rtf'
              WHEN 'text/html' THEN 'html' ELSE 'docx' END END AS extension FROM w)
SELECT page_id, concat(body_code, ':', identifier) AS storage_id, landing_key,
       concat('example/', body_code, '/', label, '/', replace(identifier, ' ', ''), '.', lower(regexp_extract(filename, '[^.]*$'))) AS curated_key,
       filename AS key_filename, url_extension, extension, guessed AS guessed_type, content_type,
       page_id % 3 <> 0 AND guessed = 'text/html' AS is_html,
       CASE WHEN page_id % 2 = 0 THEN concat('https://example.test', regexp_replace(url, '^https?://[^/]+', '')) ELSE url END AS absolute_url,
       concat('page-', page_id, '-', page_id, '.', extension) AS handoff_name
FROM x"""

ORACLES["content_hash"] = "SELECT doc_id, concat('sha256:', sha256(text)) AS file_hash FROM documents"

ORACLES["hash_parse"] = """
WITH t AS (SELECT doc_id, sha256(text) AS h FROM documents),
u AS (SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN concat('old:', h[1:8]) END AS parsed,
             CASE WHEN doc_id % 5 <> 0 THEN concat('sha256:', h) END AS stored FROM t)
SELECT doc_id, parsed, coalesce(parsed, stored) AS compared FROM u"""

ORACLES["volatile_fingerprint"] = r"""
SELECT page_id, concat('sha256:', sha256(html)) AS file_hash,
       concat('sha256:', sha256(CASE WHEN page_id % 5 = 0 THEN html
                                ELSE regexp_replace(html, '<!--\s*ad [^>]*-->', '', 'g') END)) AS content_fingerprint
FROM pages"""

ORACLES["rerun_churn"] = r"""
WITH t AS (SELECT html, CASE WHEN page_id % 2 = 0 THEN replace(html, '<!-- ad ', '<!-- ad 9') ELSE html END AS again FROM pages)
SELECT 'file_hash' AS compared_by, count(*) AS documents, CAST(count_if(sha256(html) <> sha256(again)) AS BIGINT) AS rewritten FROM t
UNION ALL
SELECT 'content_fingerprint', count(*), CAST(count_if(regexp_replace(html, '<!--\s*ad [^>]*-->', '', 'g')
       <> regexp_replace(again, '<!--\s*ad [^>]*-->', '', 'g')) AS BIGINT) FROM t"""

ORACLES["reported_total"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderkey * 3700000 AS BIGINT) END AS reported_total FROM orders"""

ORACLES["captured_split"] = f"""
WITH {RECORDS}
SELECT cell_seq, item_seq, identifier, body_code, decision_date, document_url,
       CASE WHEN failed AND o_orderpriority <> '5-LOW' THEN '504' END AS error_code,
       CASE WHEN failed THEN 'no answer in time' END AS error_reason FROM records"""

ORACLES["handoff_bad_lines"] = """
SELECT CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey END AS item_seq,
       CASE WHEN o_orderkey % 9 <> 0 THEN 'record' ELSE 'handoff_line_unreadable' END AS outcome FROM orders"""

ORACLES["unplaced_rows"] = f"""
WITH {RECORDS}
SELECT CASE WHEN item_seq % 5 = 0 THEN NULL WHEN item_seq % 7 = 0 THEN cell_seq + 1000000 ELSE cell_seq END AS cell_seq,
       identifier, document_url AS url FROM records WHERE item_seq % 5 = 0 OR item_seq % 7 = 0 OR item_seq % 11 = 0"""

ORACLES["listing_chain"] = """
WITH filled AS (SELECT o_orderkey // 10 AS page, count(*) AS n FROM orders GROUP BY 1),
cells AS (SELECT DISTINCT page // 10 AS cell_seq FROM filled),
pages AS (SELECT page // 10 AS cell_seq, page % 10 + 1 AS page_number, n, page % 13 = 3 AS unread, page % 17 = 4 AS rejects FROM filled WHERE page % 19 <> 5
          UNION ALL SELECT cell_seq, 11, 0, false, false FROM cells WHERE cell_seq % 2 = 0),
seen AS (SELECT *, unread OR rejects OR n = 0 AS stop, row_number() OVER w AS place,
                coalesce(sum(CASE WHEN unread OR rejects OR n = 0 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped
         FROM pages WINDOW w AS (PARTITION BY cell_seq ORDER BY page_number)),
walked AS (SELECT * FROM seen WHERE place = page_number AND stopped = 0),
ends AS (SELECT cell_seq, max(page_number) AS last, bool_or(stop) AS ended FROM walked GROUP BY 1)
SELECT cell_seq, CAST(page_number AS INTEGER) AS page_number, CASE WHEN unread THEN 'unread' WHEN rejects THEN 'rejected' ELSE 'records' END AS outcome,
       CASE WHEN unread THEN 1 ELSE n END AS n FROM walked WHERE n > 0
UNION ALL SELECT cell_seq, CAST(coalesce(last, 0) + 1 AS INTEGER), 'listing_page_missing', 1 FROM cells LEFT JOIN ends USING (cell_seq) WHERE NOT coalesce(ended, false)"""

_COUNTED = f"{RECORDS}, counted AS (SELECT cell_seq, body_code, count(*) AS n FROM records GROUP BY ALL)"

ORACLES["payload_attach"] = """
SELECT 'PAGE ' || page_id AS identifier,
  CASE WHEN page_id % 10 < 8 THEN 'sha256:' || sha256(html || chr(10)) END AS payload_hash,
  CASE WHEN page_id % 10 < 8 THEN CAST(strlen(html) + 1 AS BIGINT) END AS payload_bytes
FROM pages
"""
ORACLES["handoff_totals"] = f"""
WITH {_COUNTED} SELECT cell_seq, n AS reported_total FROM counted WHERE n % 2 = 0"""

_UNREAD = """
unread AS (SELECT cell_seq, CAST(NULL AS VARCHAR) AS identifier,
         concat('https://example.test/en/search/?pageNumber=5&cell=', cell_seq) AS url,
         CASE WHEN n % 2 = 0 THEN '504' ELSE 'listing_page_unreadable' END AS error_code,
         CASE WHEN n % 3 = 0 THEN 'no answer in time' ELSE 'listing page could not be read' END AS reason,
         true AS is_collection FROM counted WHERE body_code = 'o')
"""

ORACLES["listing_failures"] = f"WITH {_COUNTED}, {_UNREAD} SELECT * FROM unread"

ORACLES["download_failures"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN '503' ELSE concat(event_type, 'Error') END AS error_code,
       repeat(concat(props, ' '), 60)[1:500] AS error_reason FROM events"""

ORACLES["listing_trim"] = """
WITH p AS (SELECT event_id // 10 AS cell_seq, CAST(event_id % 10 + 1 AS INTEGER) AS page_number, event_type FROM events)
SELECT * FROM p WHERE page_number <= coalesce((SELECT min(q.page_number) FROM p q WHERE q.cell_seq = p.cell_seq
                                               AND q.event_type = 'error'), 1000)"""

_REJECT = """CASE WHEN item_seq % 11 = 0 OR item_seq % 17 = 0 THEN 'listing_row_incomplete'
                  WHEN item_seq % 13 = 0 THEN 'listing_row_bad_date' END"""

ORACLES["listing_rows"] = f"""
WITH {RECORDS}
SELECT item_seq // 10 AS cell_seq, CAST(item_seq % 10 AS INTEGER) AS position,
       CASE WHEN item_seq % 3 = 0 THEN concat('Case', chr(160), '& no ', item_seq) ELSE identifier END AS identifier,
       concat('Case', chr(160), '& no ', item_seq) AS title,
       CASE WHEN item_seq % 5 = 0 THEN '' ELSE concat(o_orderpriority, ' case') END AS description,
       decision_date, document_url, concat('cell ', item_seq // 10) AS partition_date, 'text/html' AS content_type
FROM records WHERE {_REJECT} IS NULL"""

ORACLES["listing_rejects"] = f"""
WITH {RECORDS}
SELECT item_seq // 10 AS cell_seq, CAST(item_seq % 10 AS INTEGER) AS position, {_REJECT} AS reject_reason
FROM records WHERE {_REJECT} IS NOT NULL"""

ORACLES["listing_page_totals"] = """
SELECT o_orderkey // 10 AS cell_seq, count(*) AS reported_total FROM orders GROUP BY 1"""

_SETTLED = f"""
{RECORDS},
numbered AS (SELECT *, row_number() OVER w AS rn, first_value(document_url) OVER w AS kept_url FROM records
             WINDOW w AS (PARTITION BY cell_seq, body_code, identifier ORDER BY item_seq)),
settled AS (SELECT *, CASE WHEN rn > 1 THEN 'duplicate_case_reference'
                           WHEN failed THEN CASE WHEN o_orderpriority <> '5-LOW' THEN '504' ELSE 'DocumentDownloadError' END END AS error_code,
                   CASE WHEN rn > 1 THEN concat('case reference ''', identifier, ''' is already used in this partition by ',
                             kept_url, '; this row is a different document at ', document_url)
                        WHEN failed THEN 'no answer in time' END AS error_reason FROM numbered)
"""

ORACLES["repeat_references"] = f"""
WITH {_SETTLED} SELECT cell_seq, item_seq, body_code, identifier, error_code, error_reason FROM settled WHERE rn > 1"""

ORACLES["failure_precedence"] = f"WITH {_SETTLED} SELECT item_seq, error_code FROM settled"

_DOCS = """
run1 AS (SELECT doc_id, lang, concat('sha256:', sha256(text)) AS h FROM documents),
run2 AS (SELECT doc_id, lang, concat('sha256:', sha256(CASE WHEN doc_id % 7 = 0 THEN concat(text, '!') ELSE text END)) AS h FROM documents
         UNION ALL SELECT item_id + 1000000000, 'en', concat('sha256:', sha256(text)) FROM benchmark),
compared AS (SELECT run2.*, run1.h AS old, CASE WHEN run1.h = run2.h THEN 'unchanged' ELSE 'written' END AS action
             FROM run2 LEFT JOIN run1 USING (doc_id))
"""

ORACLES["change_detection"] = f"""
WITH {_DOCS} SELECT concat('DOC-', doc_id) AS identifier, lang AS body_code, action, action = 'written' AS keep_metadata FROM compared"""

ORACLES["multi_cell_chain"] = f"""
WITH {RECORDS},
firsts AS (SELECT cell_seq, body_code, identifier, arg_min(o_orderpriority[1:1], item_seq) AS c, min(item_seq) AS item_seq,
                  cell_seq % 2 AS p FROM records GROUP BY ALL),
stored AS (SELECT body_code, identifier, arg_max(c, item_seq) AS c, arg_max(p, item_seq) AS p FROM firsts GROUP BY ALL),
live AS (SELECT f.*, coalesce(lag(f.c) OVER w, s.c) AS old_c, coalesce(lag(f.p) OVER w, s.p) AS old_p
         FROM firsts f JOIN stored s USING (body_code, identifier) WHERE f.item_seq % 19 <> 0
         WINDOW w AS (PARTITION BY f.body_code, f.identifier ORDER BY f.cell_seq)),
done AS (SELECT *, CASE WHEN c = old_c AND p = old_p THEN 'unchanged' ELSE 'written' END AS action FROM live)
SELECT cell_seq, body_code, identifier, action,
       action = 'written' AND cell_seq = max(cell_seq) FILTER (action = 'written') OVER (PARTITION BY body_code, identifier) AS keep_metadata
FROM done
UNION ALL SELECT cell_seq, body_code, identifier, 'failed', false FROM firsts WHERE item_seq % 19 = 0"""

_CURRENT = f"""{_DOCS},
current AS (SELECT doc_id, lang, h, CASE WHEN action = 'written' THEN 2 ELSE 1 END AS run_seq FROM compared)"""

ORACLES["upsert_current"] = f"""
WITH {_CURRENT}
SELECT concat(lang, ':DOC-', doc_id) AS storage_id, concat('example/', lang, '/2024-01/doc-', doc_id, '.html') AS file_path,
       h AS file_hash, h AS content_fingerprint, CAST(run_seq AS BIGINT) AS run_seq FROM current"""

ORACLES["lookup_by_key"] = f"""
WITH {_CURRENT}
SELECT concat('DOC-', doc_id) AS identifier, lang AS body_code, h AS file_hash, CAST(run_seq AS BIGINT) AS run_seq
FROM current WHERE lang = 'en' AND doc_id IN (SELECT doc_id FROM labels UNION ALL SELECT item_id + 1000000000 FROM benchmark)"""

ORACLES["range_scan"] = f"""
WITH {RECORDS}
SELECT item_seq, identifier, body_code, decision_date FROM records, bounds
WHERE decision_date >= a + 31 AND decision_date < a + CAST((b - a) // 2 AS INTEGER) ORDER BY decision_date, item_seq"""

ORACLES["transform_collect"] = f"""
WITH {RECORDS}, t AS (SELECT records.*, (decision_date - (a + 10)) // 7 AS w, a + 10 AS s FROM records, bounds
                      WHERE decision_date >= a + 10 AND decision_date < b - 10 AND item_seq % 7 > 1)
SELECT w * n + place AS cell_seq, strftime(s + CAST(w * 7 AS INTEGER), '%G-W%V') AS label, item_seq, t.body_code
FROM t JOIN ranked USING (body_code)"""

ORACLES["object_read"] = f"""
WITH {_DOCS}
SELECT concat('DOC-', doc_id) AS identifier, lang AS body_code, old IS NOT NULL AS own,
       CASE WHEN old IS NULL THEN 'landing_object_unreadable' END AS error_code FROM compared"""

ORACLES["object_exists"] = f"""
WITH {_DOCS} SELECT concat('example/', lang, '/2024-01/doc-', doc_id, '.html') AS object_key FROM run1"""


def _cleaned(html: str) -> str:
    """The curated page of a raw one: the article without its heading, unclosed tags closed at its end.

    Character references are resolved and written back; a cut one counts as a bare ampersand.
    """
    article = f"regexp_replace(regexp_extract({html}, '(?s)<article>(.*?)</article>', 1), '(?s)<h1>.*?</h1>', '')"
    title = f"regexp_extract({html}, '(?s)<title>(.*?)</title>', 1)"

    def resolved(text: str) -> str:
        return f"replace(replace(replace({text}, '&quot;', '\"'), '&amp;', '&'), '&amp', '&')"

    closing = f"repeat('</b></p>', (length({article}) - length(replace({article}, '<p><b>', ''))) // 6)"
    body = f"replace(replace({resolved(article)}, '&', '&amp;'), '<br>', '<br/>')"
    nl = "chr(10)"
    return (
        f"concat('<!DOCTYPE html>', {nl}, '<html lang=\"en\">', {nl}, '<head>', {nl}, '<meta charset=\"utf-8\">', {nl}, "
        f"'<title>', trim({resolved(title)}), '</title>', {nl}, '</head>', {nl}, '<body>', {nl}, {body}, {closing}, {nl}, "
        f"'</body>', {nl}, '</html>', {nl})"
    )


ORACLES["extract_content"] = f"""
WITH t AS (SELECT page_id, CASE WHEN page_id % 10 = 9 THEN html ELSE {_cleaned('html')} END AS c FROM pages)
SELECT page_id, concat('sha256:', sha256(c)) AS content_hash, CAST(strlen(c) AS BIGINT) AS content_bytes,
       CAST(NULL AS VARCHAR) AS extract_error FROM t"""

ORACLES["extraction_failures"] = """
SELECT CASE WHEN page_id % 3 = 1 THEN 'extracted' ELSE 'no decision content container found on page' END AS outcome,
       count(*) AS pages FROM pages GROUP BY 1"""

ORACLES["extraction_yield"] = f"""
SELECT count(*) AS raw_documents, CAST(sum(strlen(html)) AS BIGINT) AS raw_bytes, count(*) AS curated_documents,
       CAST(sum(strlen({_cleaned('html')})) AS BIGINT) AS curated_bytes FROM pages"""

ORACLES["curated_records"] = f"""
WITH {PAGES}
SELECT identifier, pagebody.body_code, strftime(d, '%Y-%m') AS partition_date,
       ((d - DATE '2024-01-01') // 7) * n + place AS cell_seq,
       concat('example/', pagebody.body_code, '/', strftime(DATE '2024-01-01' + CAST((d - DATE '2024-01-01') // 7 * 7 AS INTEGER), '%G-W%V'),
              '/PAGE', page_id, '.htm') AS file_path,
       concat('sha256:', sha256({_cleaned('html')})) AS file_hash, 'written' AS action
FROM pagebody JOIN pagebodies USING (body_code)"""

_SUMMARY = f"""
{_SETTLED}, {MONTHLY},
counted AS (SELECT cell_seq, body_code, count(*) AS n FROM records GROUP BY ALL),
grid AS (SELECT window_seq * n + place AS cell_seq, strftime(window_start, '%Y-%m') AS label, body_code FROM wins, ranked),
alive AS (SELECT * FROM settled WHERE cell_seq > 2),
{_UNREAD},
collection AS (SELECT * FROM unread WHERE cell_seq > 2
    UNION ALL SELECT range, NULL, NULL, 'PartitionIngestionError', 'crawl failed', true FROM range(0, 3)),
per_cell AS (SELECT cell_seq, count(*) AS collected, CAST(count_if(error_code IS NULL) AS BIGINT) AS w FROM alive GROUP BY 1),
lost AS (SELECT cell_seq, count(*) AS f FROM collection GROUP BY 1),
totals AS (SELECT cell_seq, n AS total FROM counted WHERE n % 2 = 0 AND cell_seq > 2),
cells AS (SELECT 'ingest' AS stage, grid.cell_seq, label AS partition, body_code AS body,
       coalesce(total, collected, 0) AS records_found, coalesce(w, 0) AS records_written,
       CAST(0 AS BIGINT) AS records_unchanged, coalesce(collected, 0) - coalesce(w, 0) + coalesce(f, 0) AS records_failed,
       coalesce(f, 0) = 0 AS collection_complete
  FROM grid LEFT JOIN per_cell USING (cell_seq) LEFT JOIN lost USING (cell_seq) LEFT JOIN totals USING (cell_seq)),
summary AS (SELECT *, collection_complete AND records_found = records_written + records_unchanged + records_failed AS accounted_for FROM cells),
failures AS (SELECT 'ingest' AS stage, grid.cell_seq, label AS partition, grid.body_code AS body, identifier, url, error_code, reason, is_collection
  FROM (SELECT cell_seq, identifier, document_url AS url, error_code, error_reason AS reason, false AS is_collection
        FROM alive WHERE error_code IS NOT NULL UNION ALL SELECT * FROM collection) JOIN grid USING (cell_seq))
"""

ORACLES["cell_summary"] = f"WITH {_SUMMARY} SELECT * FROM summary"
ORACLES["run_summary"] = f"""
WITH {_SUMMARY}
SELECT 'ingest' AS stage, 'example' AS source, (SELECT CAST(a AS VARCHAR) FROM bounds) AS start_date,
       (SELECT CAST(b AS VARCHAR) FROM bounds) AS end_date, count(*) AS partitions,
       CAST(sum(records_found) AS BIGINT) AS records_found, CAST(sum(records_written) AS BIGINT) AS records_written,
       CAST(sum(records_unchanged) AS BIGINT) AS records_unchanged, CAST(sum(records_failed) AS BIGINT) AS records_failed,
       bool_and(collection_complete) AS collection_complete, bool_and(accounted_for) AS accounted_for FROM summary"""
ORACLES["run_verdict"] = f"WITH {_SUMMARY} SELECT bool_and(accounted_for) AS succeeded FROM summary"
ORACLES["failure_list"] = f"WITH {_SUMMARY} SELECT * FROM failures"
ORACLES["failure_breakdown"] = f"WITH {_SUMMARY} SELECT stage, error_code, count(*) AS failures FROM failures GROUP BY ALL"
ORACLES["summary_lines"] = f"WITH {_SUMMARY} SELECT CAST(to_json(summary) AS VARCHAR) AS line FROM summary"

ORACLES["reference_audit"] = f"""
WITH {RECORDS}
SELECT strftime(decision_date, '%Y-%m') AS month, body_code, CAST(sum(c) AS BIGINT) AS row_count, count(*) AS distinct_references,
       CAST(count_if(c > 1) AS BIGINT) AS repeated_references
FROM (SELECT decision_date - CAST(day(decision_date) - 1 AS INTEGER) AS decision_date, body_code, identifier, count(*) AS c
      FROM records GROUP BY ALL) GROUP BY ALL"""

ORACLES["repeated_reference_rows"] = f"""
WITH {RECORDS}
SELECT partition_date AS month, body_code, identifier, count(*) OVER w AS uses, document_url FROM records
WINDOW w AS (PARTITION BY partition_date, body_code, identifier) QUALIFY uses > 1"""

ORACLES["references_in_several_cells"] = f"""
WITH {RECORDS}
SELECT body_code, identifier, count(DISTINCT partition_date) AS labels, count(*) AS row_count
FROM records GROUP BY ALL HAVING count(DISTINCT partition_date) > 1"""

ORACLES["key_collisions"] = rf"""
WITH {PAGES},
t AS (SELECT *, split_part(regexp_extract(regexp_replace(url, '/\d+(\.html)', '/page\1'), '[^/]*$'), '?', 1) AS cut FROM pagebody),
u AS (SELECT concat('example/', body_code, '/2024/', CASE WHEN contains(cut, '.') THEN cut ELSE concat(replace(identifier, ' ', ''), '.html') END) AS file_path,
             identifier FROM t)
SELECT file_path, count(DISTINCT identifier) AS identifiers, min(identifier) AS first_identifier
FROM u GROUP BY 1 HAVING count(DISTINCT identifier) > 1"""

ORACLES["last_object_wins"] = f"""
WITH {PAGES},
t AS (SELECT page_id, identifier, concat(pagebody.body_code, '/', page_id % 40) AS file_path, page_id % 3 <> 0 AS written,
             (month(d) - 1) * n + place AS cell_seq FROM pagebody JOIN pagebodies USING (body_code))
SELECT identifier, file_path,
       written AND page_id = arg_max(page_id, cell_seq * 1000000000 + page_id) FILTER (written) OVER (PARTITION BY file_path) AS keep_object
FROM t"""

ORACLES["catalogue_drift"] = """
WITH known AS (SELECT CAST(n_nationkey AS VARCHAR) AS external_id, n_name AS known_name FROM nation),
seen AS (SELECT CAST(n_nationkey + 3 AS VARCHAR) AS external_id,
                concat('NATION_', n_nationkey + 3, CASE WHEN n_regionkey = 2 THEN ' (new)' ELSE '' END) AS seen_name FROM nation)
SELECT external_id, known_name, seen_name,
       CASE WHEN known_name IS NULL THEN 'added' WHEN seen_name IS NULL THEN 'removed'
            WHEN known_name <> seen_name THEN 'renamed' ELSE 'same' END AS status
FROM known FULL JOIN seen USING (external_id)"""

ORACLES["observed_catalogue"] = "SELECT CAST(n_nationkey AS VARCHAR) AS external_id, n_name AS name, true AS found FROM nation"

ORACLES["source_union"] = r"""
SELECT 'web' AS source_name, page_id AS row_id,
       concat('sha256:', sha256(regexp_replace(html, '<!--\s*ad [^>]*-->', '', 'g'))) AS content_fingerprint FROM pages
UNION ALL
SELECT 'archive', doc_id, concat('sha256:', sha256(regexp_replace(text, '[0-9]+', '', 'g'))) FROM documents"""

ORACLES["ingest_run"] = f"""
WITH {_SETTLED}, {MONTHLY},
grid AS (SELECT window_seq * n + place AS cell_seq, strftime(window_start, '%Y-%m') AS label, body_code FROM wins, ranked),
-- a page's content is its priority, amended for one of them the second time; the path follows from cell and url
early AS (SELECT settled.* FROM (SELECT cell_seq, item_seq, body_code, identifier, partition_date, document_url, o_orderpriority, decision_date, failed,
                 row_number() OVER (PARTITION BY cell_seq, body_code, identifier ORDER BY item_seq) AS rn
          FROM records, bounds WHERE decision_date < a + CAST((b - a) // 2 AS INTEGER)) settled WHERE rn = 1 AND NOT failed),
stored AS (SELECT body_code, identifier, arg_max(o_orderpriority, cell_seq) AS c,
                  arg_max(concat(partition_date, regexp_extract(document_url, '[^/]*$')), cell_seq) AS p FROM early GROUP BY ALL),
now AS (SELECT cell_seq, body_code, identifier, concat(partition_date, regexp_extract(document_url, '[^/]*$')) AS p,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'amended' ELSE o_orderpriority END AS c FROM settled WHERE error_code IS NULL),
chained AS (SELECT now.*, coalesce(lag(now.c) OVER w, stored.c) AS old_c, coalesce(lag(now.p) OVER w, stored.p) AS old_p
            FROM now LEFT JOIN stored USING (body_code, identifier)
            WINDOW w AS (PARTITION BY now.body_code, now.identifier ORDER BY now.cell_seq)),
acted AS (SELECT cell_seq, count(*) AS live, CAST(count_if(coalesce(c = old_c AND p = old_p, false)) AS BIGINT) AS same FROM chained GROUP BY 1),
found AS (SELECT cell_seq, count(*) AS n FROM records GROUP BY 1)
SELECT grid.cell_seq, label AS partition, grid.body_code AS body, coalesce(found.n, 0) AS records_found,
       coalesce(live - same, 0) AS records_written, coalesce(same, 0) AS records_unchanged,
       coalesce(found.n, 0) - coalesce(live, 0) AS records_failed, true AS accounted_for
FROM grid LEFT JOIN found USING (cell_seq) LEFT JOIN acted USING (cell_seq)"""

_CURATED = rf"""
{PAGES},
named AS (SELECT page_id, identifier, body_code, strftime(d, '%Y-%m') AS label, html,
                 CASE WHEN regexp_matches(url, '/\d+\.html') THEN 'page.html' ELSE concat('PAGE', page_id, '.html') END AS filename
          FROM pagebody),
landed AS (SELECT *, last_value(html) OVER (PARTITION BY body_code, label, filename ORDER BY page_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS stored_html FROM named),
curated AS (SELECT concat(body_code, ':', identifier) AS storage_id, label AS partition_date,
                   concat('example/', body_code, '/', label, '/PAGE', page_id, '.html') AS file_path,
                   concat('sha256:', sha256({_cleaned('stored_html')})) AS h FROM landed)
"""

# serial order: the run that committed first, then the other
ORACLES["rebased_runs"] = ORACLES["ingest_run"]

ORACLES["transform_run"] = f"""
WITH {_CURATED} SELECT storage_id, partition_date, file_path, h AS file_hash, h AS content_fingerprint, 'text/html' AS content_type FROM curated"""

ORACLES["curated_objects"] = f"WITH {_CURATED} SELECT file_path AS object_key, h AS payload_hash FROM curated"

ORACLES["single_cell_transform"] = f"""
WITH {_CURATED}, t AS (SELECT count(*) AS n FROM landed WHERE body_code = 'en' AND label = '2024-01')
SELECT 'transform' AS stage, CAST(0 AS BIGINT) AS cell_seq, '2024-01' AS partition, 'en' AS body, n AS records_found, n AS records_written,
       CAST(0 AS BIGINT) AS records_unchanged, CAST(0 AS BIGINT) AS records_failed, true AS collection_complete, true AS accounted_for FROM t"""

ORACLES["full_run"] = f"""
WITH {PAGES}, c AS (SELECT count(*) AS n, 12 * count(DISTINCT body_code) AS cells FROM pagebody)
SELECT stage, 'example' AS source, '2024-01-01' AS start_date, '2025-01-01' AS end_date, cells AS partitions,
       n AS records_found, CAST(0 AS BIGINT) AS records_written, n AS records_unchanged, CAST(0 AS BIGINT) AS records_failed,
       true AS collection_complete, true AS accounted_for
FROM c, (VALUES ('ingest'), ('transform')) AS s(stage)"""

ORACLES["side_by_side_cells"] = f"""
WITH {RECORDS} SELECT concat(body_code, ':', identifier) AS storage_id, CASE body_code WHEN 'f' THEN 1 WHEN 'o' THEN 2 ELSE 3 END AS run_seq
FROM records GROUP BY ALL"""

ORACLES["compacted_state"] = f"""
WITH {_CURRENT}
SELECT concat(lang, ':DOC-', doc_id) AS storage_id, h AS payload_hash FROM current"""

ORACLES["single_cell"] = f"""
WITH {_SETTLED}, t AS (SELECT count(*) AS n, CAST(count_if(error_code IS NULL) AS BIGINT) AS w, min(partition_date) AS label FROM settled WHERE cell_seq = 0)
SELECT 'ingest' AS stage, CAST(0 AS BIGINT) AS cell_seq, label AS partition, 'f' AS body, n AS records_found, w AS records_written,
       CAST(0 AS BIGINT) AS records_unchanged, n - w AS records_failed, true AS collection_complete, true AS accounted_for FROM t"""
