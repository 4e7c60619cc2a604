"""Fixed values the results depend on.

FIXED VALUES -- these must equal the reference's configuration and code for the
results to agree. They are stated plainly, in their natural order.
"""

# Allowed title languages (ISO 639-1), default configuration.
ALLOWED_LANGUAGES = [
    "en", "nl", "de", "fr", "es", "it", "pt", "sv", "da", "no", "fi", "pl",
    "cs", "sk", "ro", "hu", "el", "bg", "hr", "lt", "lv", "et", "sl", "af",
]

# Institution names used in the proximity query text (title-cased when written).
INSTITUTION_NAME_DUTCH = "universiteit utrecht"
INSTITUTION_NAME_ENGLISH = "utrecht university"

# Unwanted-term patterns removed from person mentions, applied in this order.
UNWANTED_TERM_PATTERNS = [
    r"\bUtrecht University\b",
    r"\bUniversiteit Utrecht\b",
    r"\bUniversiteit\b",
    r"\bUtrecht\b",
]

# Names never treated as persons (compared case-insensitively).
BLACKLIST_NAMES = ["Anton Pijpers", "David Beverborg"]

# Source name -> home URL.
SOURCE_URL_MAP = {
    "fd.nl": "https://fd.nl",
    "volkskrant.nl": "https://www.volkskrant.nl",
    "ad.nl": "https://www.ad.nl",
    "tech daily news": "https://www.techdailynews.com",
    "nature geoscience": "https://www.nature.com/ngeo",
    "ncbi": "https://www.ncbi.nlm.nih.gov",
    "open universiteit": "https://www.ou.nl",
    "nscr": "https://nscr.nl",
    "movisie.nl": "https://www.movisie.nl",
    "university world news": "https://www.universityworldnews.com",
    "annekeschrijft.com": "https://annekeschrijft.com",
    "po-raad.nl": "https://www.poraad.nl",
}

# Faculty code -> workflow step (keys upper-cased); anything else is "approved".
WORKFLOW_STATUS = {
    "GEO": "entryInProgress",
    "GW": "entryInProgress",
    "FSW": "entryInProgress",
    "REBO": "forApproval",
    "BETA": "forApproval",
    "DGK": "approved",
}
DEFAULT_WORKFLOW = "approved"

# File-name label -> faculty code; unknown labels are kept as they are.
FACULTY_MAP = {
    "Beta 1": "BETA",
    "Beta 2": "BETA",
    "Beta 3": "BETA",
    "DGK": "DGK",
    "FSW": "FSW",
    "GEO": "GEO",
    "GW": "GW",
    "REBO": "REBO",
}

# Pattern that takes the faculty label out of a mail file name.
FACULTY_FILE_PATTERN = r"faculteit (.*?) -"

# Dutch abbreviated month names (nl_NL locale), January to December.
DUTCH_MONTHS = ["jan", "feb", "mrt", "apr", "mei", "jun", "jul", "aug", "sep", "okt", "nov", "dec"]

# Mail HTML markers.
ARTICLE_BLOCK_CLASS = "article_container"
HEADLINE_CLASS = "email-article-headline"
HARVEST_DATE_CLASS = "article-email-harvest-date"
SOURCE_NAME_CLASS = "email-article-source-name"
PERSONS_LABEL = "Personen"
HIGHLIGHT_STYLE_PATTERN = r"background:#88C53E;"
FACULTY_NAME_PATTERN = r"Faculteit [^/]+ / ([^/]+)"

# Limits.
URL_MAX_CHARS = 1024
EXCERPT_MAX_CHARS = 2000
NAMES_PER_QUERY = 1300
MATCH_THRESHOLD = 95
KEYWORDS_TOP = 5
KEYWORD_MAX_WORDS = 3
KEYWORD_DEDUP_LIMIT = 0.5
REPORT_VALUES_PER_CELL = 100
REPORT_DELIMITER = " // "
NEAR_DISTANCE = 50

# Persons export column candidates, in order of preference.
UNIT_COLUMN_CANDIDATES = [
    "Organisations > Organisational unit-0",
    "Organisational unit name",
    "Alle organisational units",
]
NAME_COLUMN_CANDIDATES = ["Name variant > Known as name-1", "Name"]
UNIT_FILL_COLUMN = "Alle organisational units"
UNIT_PATH_SEPARATOR = "//"
FACULTY_PREFIX = "Faculteit "

# Directory identifiers.
EMPLOYEE_ID_TERM = "Employee ID"
OPEN_END_DATE = "9999-12-31"

# Organisation classes.
ORG_RESEARCH = "Research organization"
ORG_DEPFAC = "dep/fac"
ORG_PLAIN = "Organization"
ORG_UNKNOWN = "Unknown"
FALLBACK_ORG_UUID = "UNKNOWN"

# Run statuses, in report order.
RUN_STATUSES = ["ok", "duplicate", "no_persons", "error"]

# Classification defaults and renames.
RESPONSE_DEFAULTS = {
    "degree": "national",
    "researcher_role": "participant",
    "typerole": "unknown",
    "Medium_type": "Web",
}
TYPEROLE_RENAMES = {
    "public engagement activity": "publicengagement",
    "expert comment": "exportcomment",
    "unknown": "other",
}
MEDIATYPE_RENAMES = {"Media Coverage": "Coverage", "Media Contribution": "Contribution"}
ROLE_RESEARCH_CITED = ["research cited", "researchcited"]
ROLE_RESEARCH_CITED_LABEL = "researchcited"
ROLES_KEPT = ["author", "interviewee"]
ROLE_OTHERWISE = "participant"
MEDIA_TYPE_CITED = "Coverage"
MEDIA_TYPE_OTHERWISE = "Contribution"
GOODFIT = "yes"
# Constants used when classification is switched off.
NO_CLASSIFIER_LABELS = {
    "article_degree": "national",
    "researcher_role": "interviewee",
    "media_type": "Contribution",
    "typerole": "exportcomment",
    "goodfit": "yes",
    "Medium_type": "Web",
}
# JSON payload row defaults when a label is missing.
PAYLOAD_DEFAULTS = {
    "Medium_type": "Web",
    "typerole": "exportcomment",
    "article_degree": "national",
    "researcher_role": "interviewee",
}
LANGUAGE_TO_COUNTRY = {"nl": "nl"}

# Output record vocabulary.
XML_NAMESPACE = "v1.unified.clipping.pure.atira.dk"
XML_WORKFLOW = "entryInProgress"
XML_VISIBILITY = "Public"
RECORD_ID_PREFIX = "Knipselkrant"
URI_CLIPPING_TYPE = "/dk/atira/pure/clipping/clippingtypes/clipping/"
URI_ROLE = "/dk/atira/pure/clipping/roles/clipping/"
URI_MEDIA_TYPE = "/dk/atira/pure/clipping/mediatype/"
URI_DEGREE = "/dk/atira/pure/clipping/degreeofrecognition/"
URI_DESCRIPTION = "/dk/atira/pure/clipping/descriptions/clippingdescription"
URI_COUNTRY = "/dk/atira/pure/core/countries/"
CLASSIFICATION_GROUP_LOGICAL_NAME = "/dk/atira/pure/clippings/keywords/imported"
CLASSIFICATION_GROUP_NAME = "Imported by media import tool"
CLASSIFICATION_URI = "/dk/atira/pure/clippings/keywords/imported/true"
PAYLOAD_VERSION = "v1"
LOCALE = "en_GB"
PERSON_ASSOCIATION_TYPE = "InternalPressMediaPersonAssociation"
SYSTEM_ORGANIZATION = "Organization"
SYSTEM_PERSON = "Person"
VISIBILITY_KEY = "FREE"
VISIBILITY_DESCRIPTION = "Public - No restriction"
DESCRIPTION_TERM = "Description"
CLASSIFICATION_GROUP_TYPE = "ClassificationsKeywordGroup"
FREE_KEYWORDS_GROUP_TYPE = "FreeKeywordsKeywordGroup"
FREE_KEYWORDS_LOGICAL_NAME = "keywordContainers"
FREE_KEYWORDS_NAME = "Keywords"
XML_ORG_LOOKUP_HINT = "orgSync"
XML_PERSON_LOOKUP_HINT = "personSync"
XML_ORIGIN = "internal"
XML_ROW_TAG = "clipping"
XML_ROOT_TAG = "clippings"

# Classification prompt, with {title} {source} {names} {organizations} {excerpt}.
PROMPT_TEMPLATE = """I have an article with the following details:
- Title: {title}
- Source: {source}
- Researcher: {names}
- Organisation: {organizations}
- Content (excerpt): {excerpt}

Return a JSON object with exactly these fields:

1. "keywords": list of 4 relevant keywords (max 2 words each)
2. "degree": one of "local", "national", "international" (English article → international)
3. "researcher_role": one of "research cited", "interviewee", "participant", "author"
   - interviewee: quoted as only person
   - author: ONLY if clearly stated
   - participant: default when in doubt
4. "typerole": one of "expert comment", "research", "public engagement activity"
5. "Medium_type": one of "Radio", "TV", "Web" (use Web if unclear)
"""
PROMPT_SYSTEM = "You are a metadata classifier. Return only valid JSON."

# English function words that no keyword phrase starts or ends with (own list).
ENGLISH_STOPWORDS = (
    "a about after all also an and any are as at be because been before being between both but by can could did do "
    "does down during each few for from further had has have he her here hers him his how i if in into is it its just "
    "me more most my no nor not now of off on once only or other our out over own s same she should so some such t than "
    "that the their them then there these they this those through to too under until up very was we were what when "
    "where which while who whom why will with would you your").split()
