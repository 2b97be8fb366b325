"""A short starter lexicon, to be replaced by the user's own tables (see sources.load_lexicon).

Lexicons are data: (term, priority, canonical, label) tables of any size, read from wherever they are kept.
What is below is enough to try the jobs, and no more.
"""

from __future__ import annotations

from ..functions.matching import Lexicon, Pattern
from ..operators.alerts import EntityRules

SYNONYMS = {"holland": "NETHERLANDS", "ivory coast": "COTE D'IVOIRE", "america": "UNITED STATES"}

DISEASE_NAMES = {
    "cholera": "CHOLERA",
    "ebola": "EBOLA DISEASE",
    "measles": "MEASLES",
    "mpox": "MONKEYPOX",
    "covid": "COVID-19",
}
DISEASES = EntityRules(
    lexicon=Lexicon.of(*DISEASE_NAMES, canonical=DISEASE_NAMES, label="DISEASE"),
    patterns=(Pattern(("yellow", "fever"), "DISEASE"), Pattern(("dengue", "fever"), "DISEASE")),
    label="DISEASE",
)
COUNTRIES = EntityRules(
    lexicon=Lexicon.of("brazil", "india", "kenya", "nigeria", "peru", *SYNONYMS, label="COUNTRY"),
    label="COUNTRY",
    mapping=SYNONYMS,
)

RELEVANT = (("cholera", "ebola", "measles", "virus", "infection"), ("outbreak", "epidemic", "cases", "quarantine"))
IRRELEVANT = ("movie", "football", "software", "stock market")
