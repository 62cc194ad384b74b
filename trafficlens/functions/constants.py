"""Fixed values of the page-view data model.

Everything below must keep these exact values for results to match the
hourly dump format and its cleaning rules; they are data, not logic.
"""

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written, in this order)
# ---------------------------------------------------------------------------

# Hourly dump file name: pageviews-YYYYMMDD-HH0000.gz -> group 1 = day, group 2 = hour.
FILENAME_PATTERN = r"pageviews-(\d{8})-(\d{2})0000\.gz$"

# Project allow-list (desktop and mobile French Wikipedia); .b, .d, .n suffixes are other projects.
DEFAULT_PROJECTS = ("fr", "fr.m")

# Project codes that count as mobile traffic by default; every other kept project is desktop.
MOBILE_PROJECTS = ("fr.m",)

# Namespace prefixes whose pages are not articles (a title "Prefix:..." is dropped).
NAMESPACE_PREFIXES = (
    "Spécial", "Special", "Spezial",
    "Wikipédia", "Wikipedia",
    "Catégorie", "Category",
    "Utilisateur", "Utilisatrice", "User",
    "Fichier", "File", "Image",
    "MediaWiki",
    "Modèle", "Template",
    "Aide", "Help",
    "Portail", "Portal",
    "Projet", "Project",
    "Référence",
    "Module",
    "Sujet",
    "Gadget", "Gadget_definition",
    "TimedText",
    "Média", "Media",
)

# Talk pages: "Discussion" followed by anything up to the separator (Discussion_utilisateur:, ...).
TALK_PREFIX = "Discussion"

# Home pages and search pages, dropped by exact title.
HOME_PAGES = (
    "-",
    "Accueil_principal",
    "Wikipédia:Accueil_principal",
    "Wikipedia:Accueil_principal",
    "Main_Page",
    "Page_d'accueil",
    "Portail:Accueil",
    "Special:Search",
    "Spécial:Recherche",
)

# Namespace separator: a colon or its percent-encoded form in either hex case.
NAMESPACE_SEPARATOR = r"(?::|%3[Aa])"
NAMESPACE_SEPARATOR_FORMS = (":", "%3A", "%3a")

# Column names of the parsed page-view table, in output order.
PAGEVIEW_COLUMNS = ("project", "title", "views", "day", "hour", "date")

# Column names of the run manifest, in file order.
RUNS_COLUMNS = (
    "run_id", "ts_utc", "job", "month", "parallelism", "duration_s", "rows_in", "rows_out",
)
