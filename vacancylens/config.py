"""Tables and limits that drive cleaning, tagging and page extraction.

Everything here is data.  Pass a changed copy (``dataclasses.replace``) to any
operator to use other words, places, skills or selectors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Results must agree with these exact words, patterns and limits.
# ---------------------------------------------------------------------------

JUNK_PATTERNS: tuple[str, ...] = (
    r"On-site",
    r"Hybrid",
    r"Remote",
    r"Full-time",
    r"Part-time",
    r"Freelance\s*/?\s*Project",
    r"Contract",
    r"Internship",
    r"More\s*Details?",
    "·",
    "�",
)

TRAILING_PLACES: tuple[str, ...] = (
    "Cairo", "Egypt", "Giza", "Maadi", "Alexandria", "New Cairo City", "Nasr City",
    "Lebanon", "Iraq", "KSA", "Dubai", "UAE", "Saudi Arabia", "Riyadh", "Jeddah",
    "Al Minufiyah", "Benha", "Port Said", "Heliopolis", "Mansoura",
    "6th of October", "Sheikh Zayed", "Obour", "Qalyoub", "Dokki", "Mohandessin",
)

TRAILING_DIVISION = r"\s*(BMB\s+\w+|More\s+Detail)$"

NON_JOB_TITLES: tuple[str, ...] = (
    "home", "careers", "career", "social", "expertise", "privacy policy",
    "powered bygdpr cookie compliance", "connectivity", "tech transformation",
    "intelligent content management", "read more", "apply now", "apply",
    "meet bmbotin our immersive reception area!",
    "find the perfect opening and apply with a click",
    "view all jobs", "see all jobs", "load more", "show more",
    "cookie policy", "terms of use", "about us", "contact us",
    "join us", "our team", "our culture", "our values",
)

MIN_TITLE_LENGTH = 5

CLEANED_FIELDS: tuple[str, ...] = (
    "title", "company", "location", "experience", "job_type",
    "career_level", "date_posted", "keywords", "description",
)

DEFAULT_SALARY = "Not Specified"
NO_SALARY: tuple[str, ...] = ("", "Not Specified", "Confidential")

SAME_DAY_WORDS: tuple[str, ...] = ("hour", "minute", "second", "moment")
DAY_WORD, WEEK_WORD, MONTH_WORD, YEAR_WORD = "day", "week", "month", "year"
DAYS_PER_MONTH = 30
DAYS_PER_YEAR = 365

MAX_LENGTHS: dict[str, int] = {
    "title": 500, "company": 255, "location": 255, "experience": 255, "job_type": 255,
    "salary": 255, "career_level": 255, "date_posted": 255,
}

DESCRIPTION_CAP = 5000

DATE_TEXT_WORDS: tuple[str, ...] = ("ago", "yesterday", "month", "year")
TOO_OLD_WORDS: tuple[str, ...] = (
    "4 months", "5 months", "6 months", "7 months", "8 months", "9 months",
    "10 months", "11 months", "year",
)
EXPERIENCE_WORDS: tuple[str, ...] = ("yr", "experience", "entry")
LEVEL_WORDS: tuple[str, ...] = (
    "entry", "junior", "mid", "senior", "manager", "director",
    "experienced", "student", "fresh",
)
CHALLENGE_PHRASES: tuple[str, ...] = (
    "captcha", "blocked", "access denied", "403 forbidden", "unusual traffic",
    "verify you are human", "just a moment",
)

SKILLS: dict[str, str] = {
    # programming languages
    "Python": r"\bpython\b",
    "SQL": r"\bsql\b",
    "Java": r"\bjava\b(?!script)",
    "JavaScript": r"\bjavascript\b|\bjs\b",
    "TypeScript": r"\btypescript\b|\bts\b",
    "C#": r"\bc#\b|\.net",
    "C++": r"\bc\+\+\b",
    "PHP": r"\bphp\b",
    "Ruby": r"\bruby\b",
    "Go": r"\bgolang\b|\bgo\b(?:\s+lang)",
    "Scala": r"\bscala\b",
    "R": r"\br programming\b|\br studio\b|\brstudio\b",
    "Swift": r"\bswift\b",
    "Kotlin": r"\bkotlin\b",
    # data and BI tools
    "Power BI": r"\bpower\s*bi\b",
    "Tableau": r"\btableau\b",
    "Excel": r"\bexcel\b",
    "Looker": r"\blooker\b",
    "DAX": r"\bdax\b",
    "SSIS": r"\bssis\b",
    "SSRS": r"\bssrs\b",
    "SSAS": r"\bssas\b",
    # data engineering
    "Spark": r"\bspark\b|\bpyspark\b",
    "Kafka": r"\bkafka\b",
    "Airflow": r"\bairflow\b",
    "dbt": r"\bdbt\b|\bdata build tool\b",
    "ETL": r"\betl\b",
    "Snowflake": r"\bsnowflake\b",
    "Databricks": r"\bdatabricks\b",
    "Hadoop": r"\bhadoop\b",
    # cloud platforms
    "AWS": r"\baws\b|\bamazon web services\b",
    "Azure": r"\bazure\b",
    "GCP": r"\bgcp\b|\bgoogle cloud\b",
    # operations
    "Docker": r"\bdocker\b",
    "Kubernetes": r"\bkubernetes\b|\bk8s\b",
    "Terraform": r"\bterraform\b",
    "CI/CD": r"\bci\s*/?\s*cd\b|\bjenkins\b|\bgithub actions\b",
    "Linux": r"\blinux\b|\bubuntu\b|\bcentos\b",
    "Git": r"\bgit\b|\bgithub\b|\bgitlab\b",
    # databases
    "PostgreSQL": r"\bpostgres\b|\bpostgresql\b",
    "MySQL": r"\bmysql\b",
    "MongoDB": r"\bmongodb\b|\bmongo\b",
    "Redis": r"\bredis\b",
    "Oracle": r"\boracle\b",
    "NoSQL": r"\bnosql\b|\bcassandra\b|\bdynamodb\b",
    # web frameworks
    "React": r"\breact\b|\breactjs\b",
    "Angular": r"\bangular\b",
    "Vue.js": r"\bvue\b|\bvuejs\b",
    "Node.js": r"\bnode\.?js\b|\bnode\b",
    "Django": r"\bdjango\b",
    "Flask": r"\bflask\b",
    "Spring": r"\bspring\s*boot\b|\bspring\b",
    # machine learning
    "Machine Learning": r"\bmachine learning\b|\bml\b",
    "Deep Learning": r"\bdeep learning\b|\bneural network\b",
    "TensorFlow": r"\btensorflow\b",
    "PyTorch": r"\bpytorch\b",
    "NLP": r"\bnlp\b|\bnatural language\b",
    "Computer Vision": r"\bcomputer vision\b|\bcv\b|\bimage recognition\b",
    # ways of working
    "Agile": r"\bagile\b|\bscrum\b|\bkanban\b",
    "Jira": r"\bjira\b",
    "SAP": r"\bsap\b",
    "Salesforce": r"\bsalesforce\b",
    # design
    "Figma": r"\bfigma\b",
    "Adobe": r"\badobe\b|\bphotoshop\b|\billustrator\b",
}

# Page selectors of the default job board layout.
CARD_SELECTOR = "div.css-pkv5jc"
CARD_FALLBACK = "div.css-1g4o566, div[class*='css-'] h2 a[href*='/jobs/p/']"
CARD_TITLE_LINK = "h2 a.css-o171kl, h2 a[href*='/jobs/p/']"
CARD_COMPANY = "a.css-ipsyv7::text"
CARD_LOCATION = "span.css-16x61xq::text"
CARD_JOB_TYPES = "span.css-1lh32fc::text, div.css-1lh32fc span::text"
DETAIL_DESCRIPTION = "div.css-n7fcne, div.css-5pnqc5"
DETAIL_REQUIREMENTS = "div.css-1lqavbg"
DETAIL_FALLBACK_TEXT = "section ::text, article ::text"
DETAIL_EXPERIENCE = "div.css-rcl8e5 span::text, span[class*='experience']::text"
DETAIL_LEVEL = "div.css-rcl8e5 span::text, span.css-1k5ee52::text"
DETAIL_SALARY = "span[class*='salary']::text, div[class*='salary']::text"
DETAIL_KEYWORDS = "a.css-1jf4wgr::text, a[class*='tag']::text, span.css-1ebpr::text"

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CleanConfig:
    """Word lists and options of the cleaning stage."""

    junk_patterns: tuple[str, ...] = JUNK_PATTERNS
    trailing_places: tuple[str, ...] = TRAILING_PLACES
    trailing_division: str = TRAILING_DIVISION
    non_job_titles: tuple[str, ...] = NON_JOB_TITLES
    min_title_length: int = MIN_TITLE_LENGTH
    cleaned_fields: tuple[str, ...] = CLEANED_FIELDS
    default_salary: str = DEFAULT_SALARY
    max_lengths: dict[str, int] = field(default_factory=lambda: dict(MAX_LENGTHS))
    weeks: bool = False
    """Read "2 weeks ago" as 14 days; off, a week text means the scrape day."""
    enforce_lengths: bool = False
    """Store only rows that fit ``max_lengths``; Parquet texts need no limit."""
    strict_dates: bool = False
    """Reject postings without any date text instead of keeping a NULL date."""


@dataclass(frozen=True)
class FieldSpec:
    """What to take from the elements a selector list picks.

    ``texts``  text nodes picked by ``::text`` selectors, in document order;
    ``blocks`` for each picked element, all text nodes below it;
    ``attr``   the named attribute of each picked element, NULL where absent.
    """

    css: str
    take: str = "texts"
    attr: str = ""


@dataclass(frozen=True)
class CardLayout:
    """How to find cards on a listing page, and the fields of a card."""

    primary: str = CARD_SELECTOR
    fallback: str = CARD_FALLBACK
    fields: dict[str, FieldSpec] = field(default_factory=lambda: {
        "title": FieldSpec(CARD_TITLE_LINK, "blocks"),
        "href": FieldSpec(CARD_TITLE_LINK, "attr", "href"),
        "company": FieldSpec(CARD_COMPANY),
        "location": FieldSpec(CARD_LOCATION),
        "job_type": FieldSpec(CARD_JOB_TYPES),
        "all_text": FieldSpec("::text"),
    })


@dataclass(frozen=True)
class DetailLayout:
    """Fields of a detail page."""

    fields: dict[str, FieldSpec] = field(default_factory=lambda: {
        "description": FieldSpec(DETAIL_DESCRIPTION, "blocks"),
        "requirements": FieldSpec(DETAIL_REQUIREMENTS, "blocks"),
        "fallback_text": FieldSpec(DETAIL_FALLBACK_TEXT),
        "experience": FieldSpec(DETAIL_EXPERIENCE),
        "career_level": FieldSpec(DETAIL_LEVEL),
        "salary": FieldSpec(DETAIL_SALARY),
        "keywords": FieldSpec(DETAIL_KEYWORDS),
    })
