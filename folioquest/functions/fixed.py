"""Results depend on these words, patterns and limits being exactly so."""

# Boilerplate phrases of a chunk.
CHUNK_PATTERNS = (
    "publicação autorizada",
    "manual de orientações",
    "vol. 160",
    "vol.160",
    "pes160",
    "conselho editorial",
    "serviço de nutrição",
    "educação em saúde",
    "educação\nem saúde",
    "aprovado pelo",
    "pacientes e cuidadores",
    "publicação\nautorizada",
)

# Words of imprints, disclosures and acknowledgements in a chunk.
METADATA_TERMS = (
    "copyright",
    "disclosure",
    "writing group",
    "writing panel",
    "permission to reproduce",
    "isbn",
    "cataloguing-in-publication",
    "endorsed or recommended",
    "expressed or implied",
    "warranty",
    "opinion whatsoever",
    "dotted line",
    "conflict of interest",
    "who press",
    "bookorders@",
    "printed by the who",
    "suggested citation",
    "annex",
    "steering committee",
    "declaration of interest",
    "heart.org/en/about-us",
    "search for guidelines",
    "browse by topic",
    "meredith.edelman@",
    "wolterskluwer",
    "writing group disclosures",
    "ownership interest",
    "research grant support",
    "honoraria",
    "gratefully acknowledges",
    "express our deep appreciation",
    "financial support",
    "abbreviations and acronyms",
    "acknowledgements",
    "table of contents",
    "low-density lipoprotein",
    "university of beirut",
    "food and drug administration",
    "health industry development",
    "nutrition guidance expert advisory",
    "guidelines review committee",
    "office of the legal counsel",
    "department of nutrition for health and development",
    "grafmac",
    "cover design and layout",
    "ministry of health, labour and welfare",
    "logistic support",
    "data collection",
)

# Marks of citations.
CITATION_TERMS = ("et al.", "doi:", "pmid:", "systematic review.", "http://", "https://")

# Names of sections that hold no content.
SKIP_SECTIONS = (
    r"©",
    r"all rights reserved",
    r"copyright",
    r"table of contents",
    r"^contents\s*$",
    r"abbreviations?\s+(and|&)\s+acronyms?",
    r"^abbreviations?$",
    r"^acknowledgements?$",
    r"members?\s+of\s+(the|who)",
    r"external\s+experts?",
    r"stakeholder\s+panel",
    r"^disclosures?$",
    r"conflict\s+of\s+interest",
    r"management\s+of\s+confl",
    r"^references?$",
    r"article\s+information",
    r"permissions\s+and\s+copyright",
    r"^annex\s+\d+",
    r"^sumário?$",
    r"^agradecimentos?$",
    r"^referências?$",
    r"^anexo\s+\d+",
    r"^siglas?\s+e\s+abreviaturas?",
)

# Lines of front matter.
FRONT_MATTER = (
    r"©",
    r"all rights reserved",
    r"copyright",
    r"ISBN",
    r"WHO Press",
    r"World Health Organization.*20 Avenue Appia",
    r"Requests for permission to reproduce",
    r"designations employed",
    r"printed by",
    r"suggested citation",
    r"WHO Library Cataloguing",
    r"^\d+\.\s+\w+.*\d+$",
)

# Beginnings of generic questions.
GENERIC_OPENERS = ("what is", "who is", "when did", "where is", "how to", "tell me about", "explain", "describe")
GENERIC_PHRASES = (
    "como proteger",
    "o que sao",
    "o que são",
    "como prevenir",
    "como melhorar",
    "como evitar",
    "o que causa",
    "qual a importancia",
    "qual a importância",
    "o que fazer para",
    "como posso mudar minha dieta",
    "como posso integrar exercicios",
    "como posso integrar exercícios",
)

# Kinds of questions and difficulties, in the order they are dealt.
QA_TYPES = ("single-hop", "multi-hop", "inference", "paraphrase", "true-false")
DIFFICULTIES = ("easy", "medium", "hard")

OTHER_CONTENT = "Other Content"
ROOT_NAME = "Document Topics"
