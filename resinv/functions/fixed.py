"""Word lists, patterns and thresholds that results depend on, stated once and plainly."""

# Patterns of a paper that introduces a resource, on the lower-cased text.
INTRODUCTION_PATTERNS = [
    r"\bwe (present|introduce|describe|developed|implemented|created|built|designed)\b.*\b(database|tool|resource|server|repository|platform|web)\b",
    r"\bhere we (present|describe|introduce|report)\b",
    r"\bthis paper (presents|introduces|describes)\b",
    r"\b(novel|new|updated|comprehensive) (database|tool|resource|server|repository|web)\b",
    r"^[A-Z][a-zA-Z0-9\-]+:\s*(a|an|the)\s+(database|tool|web server|resource|repository)",
    r"\bis (available|accessible) (at|from|via)\b",
    r"\bcan be (accessed|downloaded|found) (at|from)\b",
    r"\bfreely available\b",
]
TITLE_PATTERNS = [
    r"\b(database|server|atlas|repository|resource|portal|archive|browser|tool)\b",
    r":\s*(a|an|the)\s+\w+\s+(database|tool|resource|server|platform)",
    r"\bDB\b|\bdb$",
]
URL_PATTERN = r"https?://[^\s<>\"']+|www\.[^\s<>\"']+"
IMPLEMENTATION_KEYWORDS = [
    "implementation", "architecture", "database design", "system design", "data model", "web interface", "api", "download",
    "accessible at", "available at", "can be accessed", "built using", "developed using", "user interface", "query interface", "search interface",
]
USAGE_KEYWORDS = [
    "we used", "we employed", "we applied", "analysis revealed", "results show", "we found", "we observed", "statistically significant",
    "were analyzed", "was performed", "were compared", "were evaluated",
]
HIGH_THRESHOLD, LOW_THRESHOLD = 2.0, -1.0

# Title words of data resources, and patterns of papers on methods.
DATA_RESOURCE_WORDS = ["database", "archive", "repository", "atlas", "resource", "commons", "data management", "data integration", "data platform"]
METHODOLOGY_PATTERNS = [
    r"\btool for\b", r"\bmethod for\b", r"\bapproach for\b", r"\bframework for\b", r"\bpipeline for\b", r"\bworkflow for\b",
    r"\balgorithm for\b", r"\bprediction of\b", r"\bpredicting\b", r"\bidentifying\b", r"\bdetection of\b",
]

# Words in a title that speak of a database, with weights.
DB_KEYWORDS = ["database", "db", "server", "portal", "resource", "repository", "archive", "registry", "catalog", "collection"]
DB_WEIGHTS = {"database": 5, "server": 5, "portal": 5, "repository": 5, "resource": 3, "archive": 3, "registry": 3, "catalog": 3, "collection": 1, "db": 1}

# Domains whose URLs are no resources, words of URLs that are, academic endings, and phrases around such URLs.
EXCLUDED_DOMAINS = [
    "github.com", "gitlab.com", "bitbucket.org", "sourceforge.net", "doi.org", "dx.doi.org", "pubmed", "europepmc.org", "ncbi.nlm.nih.gov/pubmed",
    "sciencedirect.com", "springer.com", "nature.com", "cell.com", "wiley.com", "plos.org", "frontiersin.org", "mdpi.com", "biorxiv.org", "arxiv.org",
    "twitter.com", "facebook.com", "linkedin.com", "instagram.com", "researchgate.net", "academia.edu", "orcid.org", "dropbox.com", "google.com/drive",
    "drive.google.com", "onedrive.com", "figshare.com", "zenodo.org", "dryad.org", "mendeley.com", "youtube.com", "vimeo.com", "wikipedia.org",
    "google.com", "yahoo.com", "bing.com", "gmail.com", "hotmail.com", "outlook.com",
]
RESOURCE_KEYWORDS = [
    "database", "db", "bio", "genom", "protein", "gene", "tool", "portal", "server", "resource", "data", "omics", "seq", "transcriptom", "proteom",
    "metabolom", "repository", "archive", "catalog", "registry",
]
ACADEMIC_TLDS = [".edu", ".gov", ".ac.uk", ".ac.jp", ".ac.cn", ".org"]
CONTEXT_PHRASES = [
    "available at", "accessible at", "can be accessed", "hosted at", "found at", "visit", "web server", "online at", "website:", "freely available",
    "public resource", "can be downloaded", "deposited at", "available from", "accessible through", "available via",
]
RESOURCE_SUBDOMAINS = ["db.", "data.", "tools.", "portal.", "www."]

# Domains many unrelated databases share, and platforms on which the sub-domain names the database.
GENERIC_DOMAINS = ["ac.uk", "edu.cn", "ac.cn", "edu.tw", "ac.jp", "ac.kr", "ac.in", "res.in", "nih.gov", "edu.au", "ac.at", "edu"]
PLATFORMS = ["github.io", "shinyapps.io", "gbif.org", "gxbsidra.org", "herokuapp.com", "netlify.app"]
COMPOUND_SUFFIXES_DEDUP = ["ac", "co", "edu", "gov"]
COMPOUND_SUFFIXES_MATCH = ["ac", "co", "edu", "gov", "org", "res"]

# URL recovery: excluded domains, reference databases, institutional endings, exclusion patterns with reasons.
RECOVERY_EXCLUDED = [
    "github.com", "gitlab.com", "bitbucket.org", "sourceforge.net", "zenodo.org", "figshare.com", "mendeley.com", "osf.io", "dryad",
    "cran.r-project.org", "bioconductor.org", "pypi.org", "npmjs.com", "doi.org", "orcid.org", "creativecommons.org", "apache.org", "mysql.com",
    "jquery.com", "amazonaws.com", "cloudfront.net", "twitter.com", "linkedin.com", "facebook.com", "youtube.com",
]
REFERENCE_DATABASES = ["ncbi.nlm.nih.gov", "ebi.ac.uk", "uniprot.org", "genome.ucsc.edu", "kegg.jp", "ensembl.org", "string-db.org", "interpro", "pubmed", "pmc"]
INSTITUTIONAL = [".edu", ".ac.uk", ".edu.au", ".edu.cn"]
EXCLUSION_REASONS = [
    (r"github\.com/", "GitHub repository"), (r"\.github\.io/", "GitHub Pages"), (r"gitlab\.com/", "GitLab repository"),
    (r"bitbucket\.org/", "Bitbucket repository"), (r"sourceforge\.net/", "SourceForge"), (r"zenodo\.org/", "Zenodo archive"),
    (r"doi\.org/", "DOI link"), (r"datadryad\.org/", "Dryad archive"), (r"10\.5061/dryad", "Dryad DOI"), (r"figshare\.com/", "Figshare"),
    (r"m9\.figshare", "Figshare"), (r"osf\.io/", "Open Science Framework"), (r"^ftp://", "FTP server"), (r"ftp\.[a-z]", "FTP server"),
    (r"cran\.r-project\.org/", "CRAN package"), (r"bioconductor\.org/packages/", "Bioconductor package"), (r"pypi\.org/", "PyPI package"),
]
BLOCKED_PATTERNS = [
    r"oxfordjournals\.org", r"academic\.oup\.com/nar", r"mozilla\.org", r"mozilla\.com", r"bitbucket\.org", r"gitlab\.com", r"sourceforge\.net",
    r"\.pdf($|\?)", r"\.xlsx?($|\?)", r"\.docx?($|\?)", r"\.zip($|\?)", r"\.tar\.gz($|\?)", r"\.tar($|\?)", r"\.gz($|\?)", r"\.rar($|\?)", r"\.7z($|\?)",
]
REVIEW_PATTERNS = [r"github\.io", r"github\.com", r"clinicaltrials\.gov"]
BLANKS = ["", "nan", "none", "not_found", "n/a", "-"]
RECOVERY_SOURCES = ["abstract", "fulltext", "web_search", "not_available"]

# Terms of a page with their weights, title words and bonus, and the length to which a page is read.
PAGE_TERMS = {
    "NCBI": 5, "EBI": 5, "NIH": 5, "Ensembl": 5, "UniProt": 5, "search database": 4, "search our database": 4, "query database": 4,
    "browse database": 4, "download data": 4, "bulk download": 4, "data access": 4, "programmatic access": 4, "genomics": 3, "proteomics": 3,
    "bioinformatics": 3, "genome": 3, "gene": 3, "protein": 3, "sequence": 3, "molecular": 3, "biological": 3, "variant": 3, "mutation": 3,
    "expression": 3, "repository": 2, "archive": 2, "collection": 2, "resource": 2, "tool": 2, "platform": 2, "search": 2, "query": 2, "browse": 2,
    "download": 2, "submit": 2, "curated": 2, "annotation": 2, "data": 2, "database": 1, "server": 1, "portal": 1, "web service": 1,
}
PAGE_TITLE_WORDS = ["database", "server", "portal", "resource", "tool", "repository", "archive", "collection"]
PAGE_TITLE_BONUS, PAGE_CUT = 5, 512000

# Names: segments of a URL that name nothing, characters with their ASCII writing, skipped sub-domains.
SKIP_SEGMENTS = [
    "www", "db", "data", "download", "downloads", "index", "home", "browse", "search", "view", "dataset", "datasets", "ontologies", "packages",
    "fsl", "fslwiki", "php", "html", "aspx", "jsp", "species", "gene", "genes", "protein", "proteins", "genome", "tool", "tools", "resource",
    "resources", "about", "help", "api", "docs", "documentation", "wiki", "portal",
]
SKIP_SUBDOMAINS = ["www", "api", "data", "db", "portal", "web", "app", "dev"]
ASCII_WRITING = {
    "μ": "mu", "®": "(R)", "™": "(TM)", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "µ": "mu", "ø": "o", "Ø": "O",
    "é": "e", "è": "e", "ê": "e", "ë": "e", "à": "a", "á": "a", "â": "a", "ä": "a", "ü": "u", "ñ": "n",
}

# Three filter profiles: title keywords, score that bypasses them, classifier threshold, whether a URL is required.
_CONSERVATIVE = ["database", "server", "portal", "repository", "archive", "atlas", "map"]
_BALANCED = [*_CONSERVATIVE, "bank", "wiki", "hub", "resource", "browser", "db", "base"]
_AGGRESSIVE = [*_BALANCED, "tool", "network", "collection", "catalog", "platform", "pedia", "mine", "cyc"]
PROFILES = {
    "conservative": {"keywords": _CONSERVATIVE, "bypass": 6.0, "setfit": 0.60, "require_url": True},
    "balanced": {"keywords": _BALANCED, "bypass": 5.0, "setfit": 0.58, "require_url": True},
    "aggressive": {"keywords": _AGGRESSIVE, "bypass": 4.0, "setfit": 0.55, "require_url": False},
}

# Country abbreviations searched for with their case.
COUNTRY_ABBREVIATIONS = {"USA": "United States", "UK": "United Kingdom", "PRC": "China", "ROC": "Taiwan", "ROK": "Korea", "DPRK": "North Korea"}
KEYWORD_TERMS = ["database", "repository", "resource", "portal", "knowledgebase", "archive", "registry", "catalog", "collection"]
REFERENCE_YEAR, MISSING_YEAR = 2025, 2023
