"""The same results in plain SQL, for the checking engine.

Written from the meaning of each operator, not from its Spark plan: joins where
the operator uses subqueries, windows where it uses aggregates, and so on.  The
word lists come from ``config``; there is one copy of each.
"""

from __future__ import annotations

from ..config import (CHALLENGE_PHRASES, CLEANED_FIELDS, DATE_TEXT_WORDS, DESCRIPTION_CAP, EXPERIENCE_WORDS,
                      JUNK_PATTERNS, LEVEL_WORDS, MAX_LENGTHS, NON_JOB_TITLES, SKILLS, TOO_OLD_WORDS, TRAILING_PLACES)
from . import catalog as C
from . import fixtures as fx
from .fixtures import decode

FX = f"fx AS ({fx.POSTINGS.format(**fx.CHECK)})"
ACTIVE = f"{FX}, act AS (SELECT * FROM fx WHERE status = 'active')"
RAW = f"raw AS ({fx.RAW.format(**fx.CHECK)})"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_of(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {quote(w)})" for w in words) + ")"


def strip(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def clean(expr: str) -> str:
    merged = rf"regexp_replace(coalesce({expr}, ''), '\s+', ' ', 'g')"
    return rf"trim(regexp_replace({merged}, '&\w+;', '', 'g'))"


def scrub(expr: str) -> str:
    for p in JUNK_PATTERNS:
        expr = f"regexp_replace({expr}, {quote(f'(?is){p}.*')}, '')"
    return division(place(f"trim({expr})"))


def place(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {quote('(?i)(?:' + '|'.join(TRAILING_PLACES) + ')$')}, ''))"


def division(expr: str) -> str:
    return rf"trim(regexp_replace({expr}, '(?i)\s*(BMB\s+\w+|More\s+Detail)$', ''))"


def location(expr: str) -> str:
    bare = rf"trim(regexp_replace({expr}, '(?i)^Location\s*', ''))"
    return rf"trim(regexp_replace({bare}, '\s*[-–—]\s*', ', ', 'g'), ', ')"


def non_job(expr: str) -> str:
    titles = ", ".join(quote(t) for t in NON_JOB_TITLES)
    return f"(lower({expr}) IN ({titles}) OR length({expr}) < 5)"


def posting_day(text: str, base: str, weeks: bool = False) -> str:
    n = f"coalesce(try_cast(nullif(regexp_extract({text}, '[0-9]+'), '') AS INTEGER), 1)"
    low = f"lower({text})"
    week = f"WHEN contains({low}, 'week') THEN 7 * {n}" if weeks else ""
    return f"""CASE WHEN {text} = '' THEN NULL ELSE CAST(CAST({base} AS DATE) - CAST(CASE
      WHEN {any_of(low, ('hour', 'minute', 'second', 'moment'))} THEN 0
      WHEN contains({low}, 'day') THEN {n} {week}
      WHEN contains({low}, 'month') THEN 30 * {n} WHEN contains({low}, 'year') THEN 365 * {n}
      ELSE 0 END AS INTEGER) AS VARCHAR) END"""


def tags(title: str, description: str) -> str:
    # A word boundary here is between ASCII words only; writing other letters as
    # "0" makes them word characters, which no pattern of the dictionary names.
    text = rf"regexp_replace(lower({title} || ' ' || {description}), '[^\P{{L}}\x00-\x7F]', '0', 'g')"
    found = ", ".join(
        f"CASE WHEN regexp_matches(t, {quote(p.replace('(?!script)', ''))}) THEN {quote(n)} END"
        for n, p in SKILLS.items())
    return (f"(SELECT array_to_string(list_filter([{found}], lambda x: x IS NOT NULL), ', ') "
            f"FROM (SELECT {text} AS t))")


LONG = ("long_raw AS (SELECT * REPLACE (CASE WHEN seq % 9 = 0 THEN repeat(company, 90) ELSE company END AS company, "
        "CASE WHEN seq % 13 = 0 THEN repeat(url, 5) ELSE salary END AS salary) FROM raw)")


def cleaned(source: str = "raw", missing: tuple[str, ...] = ("experience", "job_type", "keywords")) -> str:
    columns = ", ".join(
        f"'' AS {c}" if c in missing else
        f"{scrub(clean(c)) if c == 'title' else location(clean(c)) if c == 'location' else clean(c)} AS {c}"
        for c in CLEANED_FIELDS)
    return (f"every AS (SELECT seq, url, coalesce(salary, 'Not Specified') AS salary, scraped_at, {columns} "
            f"FROM {source}), "
            f"cleaned AS (SELECT *, {posting_day('date_posted', 'scraped_at')} AS historical_date FROM every "
            f"WHERE NOT {non_job('title')})")


CLEANED = f"{RAW}, {cleaned()}"
TAGGED = f"{CLEANED}, tagged AS (SELECT *, {tags('title', 'description')} AS skills FROM cleaned)"
HASHED = (f"{RAW}, {LONG}, {cleaned('long_raw')}, tagged AS (SELECT *, {tags('title', 'description')} AS skills FROM "
          "cleaned), hashed AS (SELECT *, md5(company || '_' || title || '_' || location) AS job_hash FROM tagged)")

_KEPT = ("title", "company", "location", "date_posted", "keywords", "url")
_FRESH = ("experience", "job_type", "salary", "career_level", "description", "skills", "historical_date")


def stored(first_run: str, second_run: str | None) -> str:
    """The table after one batch, or after even rows and then odd rows."""
    batch = "seq % 2" if second_run else "0"
    second = second_run or first_run
    kept = ", ".join(f"max({c}) FILTER (WHERE up = 1) AS {c}" for c in _KEPT)
    fresh = ", ".join(("md5(max(description) FILTER (WHERE down = 1)) AS description") if c == "description" else
                      f"max({c}) FILTER (WHERE down = 1) AS {c}" for c in _FRESH)
    return f"""WITH {HASHED}, ranked AS (SELECT *, {batch} AS run,
      row_number() OVER (PARTITION BY job_hash ORDER BY {batch}, seq) AS up,
      row_number() OVER (PARTITION BY job_hash ORDER BY {batch} DESC, seq DESC) AS down FROM hashed)
    SELECT job_hash, {kept}, {fresh}, 'active' AS status,
      CASE WHEN min(run) = 0 THEN {quote(first_run)} ELSE {quote(second)} END AS date_first_seen,
      CASE WHEN max(run) = 1 THEN {quote(second)} ELSE {quote(first_run)} END AS date_last_seen
    FROM ranked GROUP BY job_hash"""


def upserted_thrice() -> str:
    """What views count of the table after even rows, odd rows, and every second odd row once more."""
    fresh = ", ".join(f"max({c}) FILTER (WHERE down = 1) AS {c}" for c in ("job_type", "career_level", "skills"))
    return f"""WITH {HASHED}, runs AS (SELECT *, seq % 2 AS run FROM hashed
      UNION ALL SELECT *, 2 FROM hashed WHERE seq % 4 = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY job_hash ORDER BY run, seq) AS up,
      row_number() OVER (PARTITION BY job_hash ORDER BY run DESC, seq DESC) AS down FROM runs)
    SELECT job_hash, max(company) FILTER (WHERE up = 1) AS company, max(location) FILTER (WHERE up = 1) AS location,
      {fresh}, CASE WHEN min(run) = 0 THEN {quote(C.FIRST_RUN)} ELSE {quote(C.SECOND_RUN)} END AS date_first_seen
    FROM ranked GROUP BY job_hash"""


DAY = "CAST(CAST(date_first_seen AS DATE) AS VARCHAR)"
SEEN = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
SCAN = ("title, company, location, experience, job_type, salary, career_level, CAST(NULL AS VARCHAR) AS date_posted, "
        "CAST(NULL AS VARCHAR) AS keywords, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS url, "
        "array_to_string(skills, ', ') AS skills, " + SEEN.format(c="date_first_seen") + ", "
        + SEEN.format(c="date_last_seen") + ", status")

CARDS = """links AS (SELECT page_id, url,
    regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
    regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS names FROM pages),
  pos AS (SELECT *, unnest(range(len(hrefs))) AS pos FROM links),
  cards AS (SELECT page_id, url, CAST(pos AS INTEGER) AS pos, """ + strip(decode("names[pos + 1]")) + """ AS title,
    """ + decode("hrefs[pos + 1]") + """ AS href FROM pos)"""
HEADLINE = strip(decode("regexp_extract(html, '<article><h1>([^<]*)<', 1)"))


def block_text(start: str, end: str) -> str:
    """All texts between two tags: cut at tags, stripped, blanks dropped, joined."""
    inner = f"regexp_extract(html, {quote(f'(?s){start}(.*?){end}')}, 1)"
    parts = f"list_transform(regexp_split_to_array({inner}, '<[^>]*>'), lambda x: {strip(decode('x'))})"
    return f"array_to_string(list_filter({parts}, lambda x: x <> ''), ' ')"


BODY = strip(f"{block_text('<article>', '</article>')} || ' ' || {block_text('<div class=\"ad\">', '</div>')}")
NAV = ("array_to_string(list_transform(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a>', 1), "
       f"lambda x: {decode('x')}), ' ')")


def picked(expr: str, words) -> str:
    """``expr`` stripped if it holds one of the words, else ''."""
    return f"CASE WHEN {any_of(f'lower({expr})', words)} THEN {strip(expr)} ELSE '' END"


# Raw postings from the pages: a card is a link of the menu, its detail page stands where it leads.
H1 = decode("regexp_extract(html, '<article><h1>([^<]*)<', 1)")
PAGE_RAW = f"""{CARDS},
  card AS (SELECT page_id, pos, title, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS url,
    {picked('title', DATE_TEXT_WORDS)} AS date_posted FROM cards WHERE title <> '' AND href <> ''),
  once AS (SELECT * FROM card QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, pos) = 1),
  young AS (SELECT * FROM once WHERE NOT {any_of('lower(date_posted)', TOO_OLD_WORDS)}),
  lead AS (SELECT {fx.DETAIL_URL} AS url, {picked(H1, EXPERIENCE_WORDS)} AS experience,
    {picked(H1, LEVEL_WORDS)} AS career_level, CASE WHEN {BODY} = '' THEN {NAV} ELSE {BODY} END AS description,
    array_to_string(list_filter(list_transform(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1),
      lambda x: {strip(decode('x'))}), lambda x: x <> ''), ', ') AS keywords
    FROM pages QUALIFY row_number() OVER (PARTITION BY {fx.DETAIL_URL} ORDER BY page_id) = 1),
  every_posting AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id, pos) AS copy
    FROM young JOIN lead USING (url)),
  raw AS (SELECT row_number() OVER (ORDER BY page_id, pos) AS seq, page_id, pos, title, '' AS company, '' AS location,
    experience, title AS job_type, 'Not Specified' AS salary, career_level, date_posted, keywords, description, url,
    {quote(C.FIRST_RUN)} AS scraped_at FROM every_posting WHERE copy = 1)"""


def share(part: str, whole: str) -> str:
    return f"round_even({part} * 100.0 / {whole}, 1)"


def counts(column: str, top: int | None, where: str = "") -> str:
    limit = f" LIMIT {top}" if top else ""
    where = where or f"{column} <> ''"
    return (f"WITH {ACTIVE} SELECT {column}, count(*) AS n FROM act WHERE {where} "
            f"GROUP BY {column} ORDER BY n DESC, {column}{limit}")


def view(column: str, out: str, where: str = "TRUE") -> str:
    return f"WITH {ACTIVE} SELECT {column}, count(*) AS {out} FROM act WHERE {where} GROUP BY {column}"


HAS_SALARY = "(salary IS NOT NULL AND salary NOT IN ('', 'Not Specified', 'Confidential'))"
EXPLODED = "ex AS (SELECT *, unnest(skills) AS skill FROM act)"
COOC = f"""{ACTIVE}, multi AS (SELECT job_hash, unnest(skills) AS skill FROM act WHERE len(skills) >= 2),
  best AS (SELECT skill, count(*) AS total FROM multi GROUP BY skill ORDER BY total DESC, skill LIMIT 15),
  top AS (SELECT m.* FROM multi m SEMI JOIN best USING (skill)),
  pair AS (SELECT a.skill AS s1, b.skill AS s2, count(*) AS n FROM top a JOIN top b USING (job_hash)
    WHERE a.skill <> b.skill GROUP BY ALL),
  cooc AS (SELECT a.skill AS skill_1, b.skill AS skill_2, coalesce(n, 0) AS n FROM best a CROSS JOIN
    best b LEFT JOIN pair ON s1 = a.skill AND s2 = b.skill)"""
LEVEL = f"""{ACTIVE}, ex AS (SELECT career_level, unnest(skills) AS skill FROM act WHERE career_level <> ''),
  best AS (SELECT skill FROM ex GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 10),
  lv AS (SELECT DISTINCT career_level FROM ex SEMI JOIN best USING (skill)),
  cells AS (SELECT best.skill, lv.career_level, count(ex.skill) AS n FROM best CROSS JOIN lv
    LEFT JOIN ex ON ex.skill = best.skill AND ex.career_level = lv.career_level GROUP BY ALL)"""
FEATURES = f"""{ACTIVE}, lv AS (SELECT DISTINCT career_level FROM act WHERE career_level IS NOT NULL),
  co AS (SELECT company, count(title) AS total_jobs FROM act WHERE company IS NOT NULL GROUP BY company),
  feat AS (SELECT company, total_jobs, 'total_jobs' AS feature, total_jobs AS n FROM co
    UNION ALL SELECT co.company, total_jobs, 'level_' || lv.career_level, count(act.company) FROM co CROSS JOIN lv
      LEFT JOIN act ON act.company = co.company AND act.career_level = lv.career_level GROUP BY ALL)"""
TFIDF = rf"""{ACTIVE}, doc AS (SELECT job_hash, regexp_extract_all(lower(array_to_string(skills, ' ')), '\b\w\w+\b')
    AS tokens FROM act WHERE len(skills) > 0),
  tok AS (SELECT job_hash, unnest(tokens) AS term FROM doc),
  tf AS (SELECT job_hash, term, count(*) AS tf FROM tok GROUP BY ALL),
  voc AS (SELECT term, sum(tf) AS total, ln((1.0 + (SELECT count(*) FROM doc)) / (1.0 + count(*))) + 1.0 AS idf
    FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 100),
  w AS (SELECT job_hash, term, tf * idf AS x FROM tf JOIN voc USING (term))"""


WEIGHTS = "x AS (SELECT job_hash AS key, job_hash, term, x / sqrt(sum(x * x) OVER (PARTITION BY job_hash)) AS x FROM w)"
SCALED = ("x AS (SELECT company AS key, feature AS term, coalesce((n - avg(n) OVER v) / nullif(stddev_pop(n) OVER v, 0), 0) "
          "AS x FROM feat WHERE total_jobs >= 3 WINDOW v AS (PARTITION BY feature))")
TOTAL = ("total AS (SELECT round((sum(q) - sum(s * s) / any_value(n)) / any_value(n), 9) AS total FROM (SELECT term, sum(x) AS s, "
         "sum(x * x) AS q FROM x GROUP BY term), (SELECT count(DISTINCT key) AS n FROM x))")


def _projected(weights: str) -> str:
    return f"""WITH {weights}, {WEIGHTS}, c AS (SELECT count(*) AS n FROM doc),
      v AS (SELECT sum(x * x) / any_value(n) - pow(sum(x) / any_value(n), 2) AS v FROM x, c GROUP BY term)
    SELECT any_value(n) AS n, CAST(0.0 AS DOUBLE) AS mean_1, CAST(0.0 AS DOUBLE) AS mean_2, true AS ordered,
      CAST(0.0 AS DOUBLE) AS shared, round(sum(v), 9) AS total, round(max(v), 9) AS largest, true AS widest FROM v, c"""


def _column_report(select: str) -> str:
    columns = [("title", "string"), ("company", "string"), ("location", "string"), ("experience", "string"),
               ("job_type", "string"), ("salary", "string"), ("career_level", "string"), ("date_posted", "string"),
               ("keywords", "string"), ("description", "string"), ("url", "string"), ("skills", "array<string>"),
               ("date_first_seen", "timestamp_ntz"), ("date_last_seen", "timestamp_ntz"), ("status", "string")]
    absent = {"date_posted", "keywords", "description", "url"}
    parts = []
    for i, (name, kind) in enumerate(columns):
        column = "CAST(NULL AS VARCHAR)" if name in absent else name
        empty = f"count(*) FILTER (WHERE {column} = '')" if kind == "string" else "CAST(0 AS BIGINT)"
        parts.append("SELECT " + select.format(pos=i, name=name, kind=kind, c=column, empty=empty) + " FROM act")
    return f"WITH {ACTIVE} " + " UNION ALL ".join(parts)


def _case_link() -> str:
    origin = "regexp_extract(url, '^[a-z]+://[^/?#]*')"
    path = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
    word = "substr(href, 2)"
    folder = f"regexp_replace({path}, '[^/]*$', '')"
    above = f"regexp_replace({folder}, '[^/]+/$', '')"
    return f"""CASE pos WHEN 0 THEN {origin} || href WHEN 1 THEN {origin} || {folder} || {word}
      WHEN 2 THEN 'https://cdn.example.org' || href
      WHEN 3 THEN regexp_extract(url, '^[a-z]+:') || '//cdn.example.org' || href
      WHEN 4 THEN {origin} || {path} || '?p=' || {word}
      ELSE {origin} || {above} || 'a/' || {word} END"""


def oracle_sql() -> dict[str, str]:
    raw = f"WITH {RAW} "
    act = f"WITH {ACTIVE} "
    upserted = stored(C.FIRST_RUN, C.SECOND_RUN)
    title = clean("title")
    words = "list_filter(string_split(text, ' '), lambda x: " + any_of("lower(x)", LEVEL_WORDS) + ")[1]"
    dateish = (f"list_filter([title, location, upper(date_posted), url], lambda x: "
               f"{any_of('lower(x)', DATE_TEXT_WORDS)})[1]")
    expish = (f"list_filter([location, job_type, experience, salary], lambda x: "
              f"{any_of('lower(x)', EXPERIENCE_WORDS)})[1]")
    said = ("CASE seq % 3 WHEN 0 THEN CAST(seq % 30 AS VARCHAR) || ' Months ago' "
            "WHEN 1 THEN CAST(seq % 30 AS VARCHAR) || ' month ago' ELSE date_posted END")
    nations = ("list_sort(list(n.n_name) FILTER (WHERE regexp_matches(lower(title || ' ' || location || ' ' || "
               r"description), '\b' || lower(n.n_name) || '\b')))")
    return {
        "scan_active": f"{act} SELECT {SCAN} FROM act",
        "ensure_columns": f"""WITH {FX} SELECT job_hash, title, CAST(NULL AS VARCHAR) AS experience, job_type,
            'Not Specified' AS salary, career_level, CAST(NULL AS VARCHAR) AS date_posted,
            CAST(NULL AS VARCHAR) AS keywords, CAST(NULL AS VARCHAR) AS description,
            CAST(NULL AS VARCHAR) AS skills, CAST(NULL AS VARCHAR) AS historical_date FROM fx""",
        "csv_backup": f"WITH {TAGGED} SELECT title, company, location, experience, job_type, salary, career_level, "
            "date_posted, keywords, url, skills, CAST(scraped_at AS VARCHAR) AS scraped_at, md5(description) AS description "
            "FROM tagged",
        "csv_snapshot": f"{act} SELECT {SCAN} FROM act",
        "read_pages": "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars, md5(html) AS digest FROM pages",
        "upsert_sink": upserted,
        "live_views": f"""WITH t AS ({upserted_thrice()}),
            e AS (SELECT 'v_hiring_trends' AS view, left(date_first_seen, 10) AS key FROM t
              UNION ALL SELECT 'v_top_companies', company FROM t
              UNION ALL SELECT 'v_skill_frequency', unnest(string_split(skills, ', ')) FROM t WHERE skills <> ''
              UNION ALL SELECT 'v_job_type_breakdown', job_type FROM t WHERE job_type <> ''
              UNION ALL SELECT 'v_career_level_distribution', career_level FROM t WHERE career_level <> ''
              UNION ALL SELECT 'v_location_distribution', location FROM t WHERE location <> '')
            SELECT view, key, count(*) AS n FROM e GROUP BY ALL""",
        "preview": f"{act} SELECT title, company, {SEEN.format(c='date_first_seen')} FROM act "
            "ORDER BY act.date_first_seen DESC, title LIMIT 5",
        "schema_report": _column_report(
            "{pos} AS pos, '{name}' AS column_name, '{kind}' AS data_type, count({c}) AS non_null"),
        "extract_cards": f"WITH {CARDS} SELECT page_id, pos, title, href FROM cards",
        "first_text": f"SELECT page_id, {HEADLINE} AS headline FROM pages",
        "resolve_url": f"WITH {CARDS} SELECT page_id, pos, {_case_link()} AS link FROM cards",
        "require_fields": f"""WITH {CARDS} SELECT page_id, pos, title, href FROM cards
            WHERE (page_id + pos) % 3 <> 0 AND (page_id + pos) % 5 <> 0 AND title <> '' AND href <> ''""",
        "strip_company": raw + "SELECT seq, trim(rtrim(company || CASE seq % 3 WHEN 0 THEN ' - ' "
            "WHEN 1 THEN ' --  -' ELSE '-a' END, ' -')) AS company FROM raw",
        "join_tags": "SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, "
            f"'<li><a href=\"[^\"]*\">([^<]*)</a>', 1), lambda x: {strip(decode('x'))}), lambda x: x <> ''), ', ') "
            "AS tags FROM pages",
        "pick_date_text": raw + f"SELECT seq, coalesce({strip(dateish)}, '') AS date_text FROM raw",
        "age_cut": raw + f"SELECT seq, date_posted FROM (SELECT seq, {said} AS date_posted FROM raw) "
            f"WHERE NOT {any_of('lower(date_posted)', TOO_OLD_WORDS)}",
        "full_text": f"SELECT page_id, md5(CASE WHEN page_id % 4 = 0 OR {BODY} = '' THEN {NAV} ELSE {BODY} END) "
            "AS digest FROM pages",
        "pick_experience": act + f"SELECT title, coalesce({strip(expish)}, '') AS experience FROM act",
        "pick_career_level": f"SELECT doc_id, coalesce({strip(words)}, '') AS career_level FROM documents",
        "pick_salary": raw + "SELECT seq, CASE WHEN coalesce(salary, '') = '' THEN 'Not Specified' ELSE salary END "
            "AS salary FROM raw",
        "join_card_detail": f"""WITH c AS (SELECT page_id, {HEADLINE} AS title,
              CASE WHEN page_id % 3 = 0 THEN url || '/gone' ELSE url END AS url FROM pages),
            b AS (SELECT url, md5(CASE WHEN {BODY} = '' THEN {NAV} ELSE {BODY} END) AS digest
              FROM pages)
            SELECT page_id, title, url, digest FROM c JOIN b USING (url)""",
        "extract_postings": f"WITH {PAGE_RAW} SELECT page_id, pos, title, company, location, experience, job_type, salary, "
            "career_level, date_posted, keywords, md5(description) AS description, url, scraped_at FROM raw",
        "stream_pages": f"WITH {PAGE_RAW} SELECT page_id, pos, title, company, location, experience, job_type, salary, "
            "career_level, date_posted, keywords, md5(description) AS description, url, scraped_at FROM raw",
        "ingest_pages": f"""WITH {PAGE_RAW}, {cleaned('raw', ())},
            ok AS (SELECT *, {tags('title', 'description')} AS skills FROM cleaned
              QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1),
            hashed AS (SELECT *, md5(company || '_' || title || '_' || location) AS job_hash FROM ok),
            ends AS (SELECT job_hash, min(seq) AS up, max(seq) AS down FROM hashed GROUP BY job_hash),
            kept AS (SELECT job_hash, a.title, b.job_type, b.career_level, a.keywords, a.url, b.skills, b.description,
              CAST(NULL AS VARCHAR) AS reject_reason
              FROM ends JOIN hashed a USING (job_hash) JOIN hashed b USING (job_hash) WHERE a.seq = up AND b.seq = down),
            lost AS (SELECT CAST(NULL AS VARCHAR) AS job_hash, title, job_type, career_level, keywords, url,
              CAST(NULL AS VARCHAR) AS skills, description, 'non_job' AS reject_reason FROM every
              WHERE seq NOT IN (SELECT seq FROM cleaned))
            SELECT r.* REPLACE (md5(description) AS description), CASE WHEN reject_reason IS NULL THEN 1 END AS in_csv
            FROM (SELECT * FROM kept UNION ALL SELECT * FROM lost) r""",
        "cap_text": f"SELECT doc_id, CAST(length(substr(text, 1, {DESCRIPTION_CAP})) AS INTEGER) AS n_kept, "
            f"md5(substr(text, 1, {DESCRIPTION_CAP})) AS digest FROM documents",
        "stamp_scraped": raw + "SELECT seq, CASE WHEN seq % 3 <> 0 THEN strftime(scraped_at, '%Y-%m-%d %H:%M:%S') "
            f"ELSE {quote(C.FIRST_RUN)} END AS scraped_at FROM raw",
        "flag_blocked": "SELECT page_id, page_id % 7 IN (0, 3) OR regexp_matches(lower(html), "
            f"{quote('|'.join(CHALLENGE_PHRASES))}) AS blocked FROM pages",
        "location_prefix": raw + r"SELECT seq, CASE WHEN seq % 2 = 0 THEN trim(lower(location)) "
            r"ELSE trim(regexp_replace(location, '^Location\s*', '')) END AS location FROM raw",
        "clean_text": raw + "SELECT seq, " + ", ".join(
            f"{clean(c)} AS {c}" for c in ("title", "location", "date_posted", "salary"))
            + f", md5({clean('description')}) AS description FROM raw",
        "scrub_title": raw + f"SELECT seq, {scrub(title)} AS title FROM raw",
        "strip_place": raw + "SELECT seq, " + place(
            f"({title} || CASE seq % 4 WHEN 0 THEN 'Giza' WHEN 1 THEN ' nasr city' WHEN 2 THEN 'New Cairo City' "
            "ELSE ' Cairo Branch' END)") + " AS title FROM raw",
        "strip_division": raw + "SELECT seq, " + division(
            f"({title} || CASE seq % 3 WHEN 0 THEN ' bmb Reach' WHEN 1 THEN 'More  Detail' "
            "ELSE ' BMB Reach Team' END)") + " AS title FROM raw",
        "clean_location": raw + f"SELECT seq, {location('location')} AS location FROM raw",
        "non_job": raw + f"SELECT seq, t AS title, {non_job('t')} AS non_job FROM (SELECT seq, {scrub(title)} AS t "
            "FROM raw)",
        "rejects": f"WITH {RAW}, {LONG}, {cleaned('long_raw')}, firsts AS (SELECT min(seq) AS seq FROM cleaned "
            "GROUP BY url) SELECT seq, CASE WHEN c.seq IS NULL THEN 'non_job' WHEN f.seq IS NULL THEN 'duplicate' "
            + " ".join(f"WHEN length(e.{c}) > {n} THEN 'too_long:{c}'" for c, n in MAX_LENGTHS.items())
            + " END AS reject_reason FROM every e LEFT JOIN cleaned c USING (seq) LEFT JOIN firsts f USING (seq)",
        "relative_date": raw + f"SELECT seq, {posting_day('date_posted', 'scraped_at')} AS historical_date, "
            f"{posting_day('date_posted', 'scraped_at', True)} AS with_weeks FROM raw",
        "constraint_guard": f"WITH {RAW}, {LONG} SELECT seq, company, salary FROM long_raw "
            "WHERE length(company) <= 255 AND coalesce(length(salary), 0) <= 255",
        "apply_defaults": raw + "SELECT seq, coalesce(salary, 'Not Specified') AS salary FROM raw",
        "clean_postings": f"WITH {CLEANED} SELECT seq, title, company, location, experience, job_type, salary, "
            "career_level, date_posted, keywords, md5(description) AS description, url, historical_date FROM cleaned",
        "dedup_url": raw + "SELECT min(seq) AS seq, url FROM raw GROUP BY url",
        "dedup_key": raw + "SELECT seq, company, title, location FROM raw QUALIFY row_number() OVER "
            "(PARTITION BY company, title, location ORDER BY seq) = 1",
        "job_hash": f"WITH {CLEANED} SELECT seq, md5(company || '_' || title || '_' || location) AS job_hash "
            "FROM cleaned",
        "tag_skills": raw + f"SELECT seq, {tags('title', 'description')} AS skills FROM raw",
        "skill_dictionary": raw + f"SELECT seq, coalesce(array_to_string({nations}, ', '), '') AS skills "
            "FROM raw CROSS JOIN nation n GROUP BY seq",
        "skill_table": raw + f"SELECT seq, coalesce(array_to_string({nations}, ', '), '') AS skills "
            "FROM raw CROSS JOIN nation n GROUP BY seq",
        "skill_patterns": raw + "SELECT seq, coalesce(array_to_string(" + nations.replace(
            r"'\b' || lower(n.n_name) || '\b'", r"CASE n_nationkey % 3 WHEN 0 THEN '\b' || lower(n.n_name) || '\b' ELSE "
            "lower(n.n_name) END") + ", ', '), '') AS skills FROM raw CROSS JOIN nation n GROUP BY seq",
        "ingest_batch": f"WITH {TAGGED} SELECT seq, title, location, url, skills FROM tagged "
            "QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1",
        "upsert_postings": upserted,
        "v_job_types_expanded": act + "SELECT job_hash, trim(unnest(string_split(job_type, ','))) "
            "AS job_type_individual FROM act WHERE job_type <> ''",
        "v_job_skills_expanded": act + "SELECT job_hash, unnest(skills) AS skill FROM act",
        "v_skill_frequency": act + ", u AS (SELECT unnest(skills) AS skill FROM act) "
            "SELECT skill, count(*) AS frequency FROM u GROUP BY skill",
        "v_hiring_trends": f"WITH {FX} SELECT {DAY} AS scrape_date, count(*) AS new_jobs FROM fx GROUP BY 1",
        "v_top_companies": view("company", "open_positions"),
        "v_job_type_breakdown": view("job_type", "count", "job_type <> ''"),
        "v_career_level_distribution": view("career_level", "count", "career_level <> ''"),
        "v_location_distribution": view("location", "count", "location <> ''"),
        "v_location_hierarchy": act + ", p AS (SELECT DISTINCT location, string_split(location, ',') AS parts "
            "FROM act WHERE location <> '') SELECT location, trim(parts[len(parts)]) AS country, "
            "CASE WHEN len(parts) >= 2 THEN trim(parts[len(parts) - 1]) ELSE 'Unknown' END AS city, "
            "CASE WHEN len(parts) >= 3 THEN trim(parts[len(parts) - 2]) ELSE 'Unknown' END AS area FROM p",
        "load_summary": act + "SELECT count(*) AS jobs, count(DISTINCT company) AS companies, "
            "count(DISTINCT location) AS locations, strftime(min(date_first_seen), '%Y-%m-%d %H:%M:%S') AS first_seen, "
            "strftime(max(date_first_seen), '%Y-%m-%d %H:%M:%S') AS last_seen FROM act",
        "quality_audit": _column_report(
            "'{name}' AS column_name, count(*) AS total, count({c}) AS non_null, {empty} AS empty_strings, "
            + share("(count({c}) - {empty})", "count(*)") + " AS useful_pct"),
        "top_companies": counts("company", 20, "company IS NOT NULL"),
        "top_skills": f"{act}, {EXPLODED} SELECT skill, count(*) AS frequency, "
            + share("count(*)", "(SELECT count(*) FROM act)")
            + " AS pct_of_jobs FROM ex WHERE skill <> '' GROUP BY skill ORDER BY frequency DESC, skill LIMIT 25",
        "skill_stats": f"{act}, {EXPLODED}, f AS (SELECT skill, count(*) AS n FROM ex WHERE skill <> '' GROUP BY skill) "
            "SELECT count(*) AS n_skills, count(DISTINCT n) AS n_distinct_frequencies, "
            "(SELECT avg(len(skills)) FROM act) AS avg_skills_per_job FROM f",
        "top_locations": counts("location", 15),
        "career_level_share": act + "SELECT career_level, count(*) AS n, "
            + share("count(*)", "sum(count(*)) OVER ()")
            + " AS share_pct FROM act WHERE career_level <> '' GROUP BY career_level",
        "job_type_top": counts("job_type", 10),
        "hiring_trend": act + f", d AS (SELECT {DAY} AS day, count(*) AS new_jobs FROM act GROUP BY 1) "
            "SELECT day, new_jobs, CAST(sum(new_jobs) OVER (ORDER BY day) AS BIGINT) AS total_jobs FROM d",
        "trend_stats": act + f", d AS (SELECT {DAY} AS day, count(*) AS n FROM act GROUP BY 1) "
            "SELECT min(day) AS first_day, max(day) AS last_day, avg(n) AS avg_jobs_per_day FROM d",
        "salary_coverage": act + f"SELECT count(*) AS total, count(*) FILTER (WHERE {HAS_SALARY}) AS with_salary, "
            f"count(*) FILTER (WHERE NOT {HAS_SALARY}) AS without_salary, "
            + share(f"count(*) FILTER (WHERE {HAS_SALARY})", "count(*)") + " AS pct FROM act",
        "salary_sample": act + f"SELECT title, company, salary FROM act WHERE {HAS_SALARY} "
            "ORDER BY date_first_seen DESC, title LIMIT 15",
        "skill_cooccurrence": f"WITH {COOC} SELECT skill_1, skill_2, n FROM cooc",
        "cooccurrence_matrix": f"WITH {COOC} SELECT skill_1, string_agg(skill_2, ', ' ORDER BY skill_2) AS skills, "
            "string_agg(CAST(n AS VARCHAR), ', ' ORDER BY skill_2) AS counts FROM cooc GROUP BY skill_1",
        "experience_top": counts("experience", 10),
        "skill_by_level": f"WITH {LEVEL} SELECT skill, career_level, n FROM cells",
        "skill_level_crosstab": f"WITH {LEVEL} SELECT skill, string_agg(career_level, ', ' ORDER BY career_level) "
            "AS levels, string_agg(CAST(n AS VARCHAR), ', ' ORDER BY career_level) AS counts FROM cells GROUP BY skill",
        "kpi_summary": f"{act}, {EXPLODED}, f AS (SELECT skill, count(*) AS n FROM ex WHERE skill <> '' GROUP BY skill) "
            "SELECT count(*) AS jobs, count(DISTINCT company) AS companies, count(DISTINCT location) AS locations, "
            "(SELECT count(*) FROM f) AS skills, (SELECT count(DISTINCT n) FROM f) AS distinct_skill_frequencies, "
            f"count(*) FILTER (WHERE {HAS_SALARY}) AS with_salary, "
            + share(f"count(*) FILTER (WHERE {HAS_SALARY})", "count(*)") + " AS salary_pct, "
            "count(*) FILTER (WHERE career_level <> '') AS with_career_level, "
            + share("count(*) FILTER (WHERE career_level <> '')", "count(*)") + " AS career_level_pct FROM act",
        "value_counts": counts("salary", None),
        "tfidf_skills": f"WITH {TFIDF} SELECT job_hash, term, "
            "round(x / sqrt(sum(x * x) OVER (PARTITION BY job_hash)), 9) AS weight FROM w",
        "company_features": f"WITH {FEATURES} SELECT company, feature, n FROM feat",
        "level_counts": f"WITH {ACTIVE} SELECT company, career_level, count(*) AS n FROM act GROUP BY ALL",
        "min_volume": f"WITH {FEATURES} SELECT company, feature, n FROM feat WHERE total_jobs >= 3",
        "scale_features": f"WITH {FEATURES} SELECT company, feature, round(coalesce((n - avg(n) OVER w) / "
            "nullif(stddev_pop(n) OVER w, 0), 0), 9) + 0.0 AS z FROM feat WHERE total_jobs >= 3 "
            "WINDOW w AS (PARTITION BY feature)",
        # A fit is checked by what every right fit has, see the catalog.
        "role_clusters": f"WITH {TFIDF}, {WEIGHTS}, {TOTAL}, k AS (SELECT least({C.ROLE_CLUSTERS}, count(DISTINCT list_sort("
            "tokens))) AS k FROM doc) SELECT DISTINCT job_hash, true AS nearest, k AS n_clusters, total, true AS tighter "
            "FROM x, k, total",
        "cluster_terms": f"SELECT CAST(c.range AS INTEGER) AS cluster, CAST(r.range AS INTEGER) AS rank, "
            f"CAST(0.0 AS DOUBLE) AS off, true AS heaviest FROM range({C.ROLE_CLUSTERS}) c CROSS JOIN "
            f"range(1, {C.TERMS_EACH + 1}) r",
        "pca_2d": _projected(TFIDF),
        "pca_sparse": _projected(TFIDF.replace("LIMIT 100", "")),
        "company_segments": f"WITH {FEATURES}, {SCALED}, {TOTAL} SELECT company, true AS nearest, "
            f"{C.SEGMENTS} AS n_clusters, total, true AS tighter, total_jobs FROM feat, total "
            "WHERE total_jobs >= 3 AND feature = 'total_jobs'",
        "segment_plot_data": f"WITH {FEATURES}, low AS (SELECT min(career_level) AS career_level FROM lv) "
            f"SELECT company, total_jobs, n AS first_level_jobs, true AS nearest, {C.SEGMENTS} AS n_clusters, true AS tighter "
            "FROM feat, low WHERE total_jobs >= 3 AND feature = 'level_' || low.career_level",
        "load_summary_sketched": f"{act} SELECT count(*) AS jobs, count(DISTINCT company) AS companies, "
            "count(DISTINCT location) AS locations, (SELECT count(DISTINCT s) FROM (SELECT unnest(skills) AS s FROM act) "
            f"WHERE trim(s) <> '') AS skills, {SEEN.format(c='min(date_first_seen)').split(' AS ')[0]} AS first_seen, "
            f"{SEEN.format(c='max(date_first_seen)').split(' AS ')[0]} AS last_seen, true AS companies_near, "
            "true AS locations_near, true AS skills_near FROM act",
        "top_parts": "SELECT CAST(l_partkey AS VARCHAR) AS part, count(*) AS lines FROM lineitem GROUP BY part ORDER BY lines DESC, part "
            "LIMIT 20",
        "skill_pairs": act + """, m AS (SELECT job_hash, unnest(skills) AS s, unnest(range(len(skills))) AS i FROM (
              SELECT row_number() OVER () AS job_hash, skills FROM act WHERE len(skills) >= 2)),
            top AS (SELECT s FROM m GROUP BY s ORDER BY count(*) DESC, s LIMIT 200),
            n AS (SELECT a.s AS skill_1, b.s AS skill_2, count(*) AS n FROM m a JOIN m b ON a.job_hash = b.job_hash
              AND a.i <> b.i GROUP BY ALL)
            SELECT a.s AS skill_1, b.s AS skill_2, coalesce(n, 0) AS n FROM top a CROSS JOIN top b
            LEFT JOIN n ON skill_1 = a.s AND skill_2 = b.s""",
        "listed_titles": f"WITH {CLEANED} SELECT seq, title FROM every WHERE lower(trim(title)) NOT IN (SELECT "
            "lower(trim(title)) FROM every WHERE company IN ('src0', 'src3', 'src6') AND seq % 4 < 3)",
        "stream_clean": f"WITH {TAGGED} SELECT seq, title, location, historical_date, skills FROM tagged",
        "stream_dedup": f"WITH {CLEANED} SELECT seq, title, company, location, experience, job_type, salary, "
            "career_level, date_posted, keywords, md5(description) AS description, url, historical_date FROM cleaned "
            "QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1",
        "stream_upsert": stored(C.FIRST_RUN, None),
        "stream_trend": f"WITH {FX} SELECT {DAY} AS scrape_date, count(*) AS new_jobs FROM fx GROUP BY 1",
    }
