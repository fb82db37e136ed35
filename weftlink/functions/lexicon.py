"""Word lists of company names and addresses. They decide which records share keys."""

LEGAL_SUFFIXES = """
inc incorporated corp corporation co company ltd limited pvt private llc llp pllc
enterprises enterprise industries industry technologies technology services service
solutions solution group holdings ventures consulting associates trading systems
system international holding
sarl sas sasu sci sa snc eurl ste gmbh bv gie ei scp selarl earl scic sem
participations distribution france etablissement ets cie compagnie groupe
""".split()

ARTICLES = "the a an le la les l un une du des de d el los las".split()

#: Fixed values, abbreviation: expansion. Of those that French and English share (st, ste) the French word holds.
ADDRESS_WORDS = {
    "rd": "road", "st": "saint", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "ct": "court", "ln": "lane", "pl": "place", "sq": "square",
    "terr": "terrace", "pkwy": "parkway", "hwy": "highway", "fl": "floor", "ste": "sainte", "apt": "apartment", "bldg": "building", "no": "number",
    "nr": "near", "opp": "opposite", "r": "rue", "av": "avenue", "bd": "boulevard", "ch": "chemin", "imp": "impasse", "all": "allee", "rte": "route",
    "crs": "cours", "qu": "quai", "pass": "passage", "bat": "batiment", "res": "residence", "zi": "zone industrielle", "za": "zone activite",
}

#: Fixed values, state code: name. Of those that India and the US share (ar, as, ga, mn, tn and others) the Indian state holds.
STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ca": "california", "co": "colorado", "ct": "connecticut", "de": "delaware", "fl": "florida",
    "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana", "ia": "iowa", "ks": "kansas", "ky": "kentucky", "la": "louisiana",
    "me": "maine", "md": "maryland", "ma": "massachusetts", "mi": "michigan", "ms": "mississippi", "mo": "missouri", "mt": "montana",
    "ne": "nebraska", "nv": "nevada", "nh": "new hampshire", "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina",
    "nd": "north dakota", "oh": "ohio", "ok": "oklahoma", "or": "oregon", "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina",
    "sd": "south dakota", "tx": "texas", "ut": "utah", "vt": "vermont", "va": "virginia", "wa": "washington", "wv": "west virginia",
    "wi": "wisconsin", "wy": "wyoming", "dc": "district of columbia", "ap": "andhra pradesh", "ar": "arunachal pradesh", "as": "assam", "br": "bihar",
    "cg": "chhattisgarh", "dl": "delhi", "ga": "goa", "gj": "gujarat", "hr": "haryana", "hp": "himachal pradesh", "jh": "jharkhand",
    "ka": "karnataka", "kl": "kerala", "mp": "madhya pradesh", "mh": "maharashtra", "mn": "manipur", "ml": "meghalaya", "mz": "mizoram",
    "nl": "nagaland", "od": "odisha", "pb": "punjab", "rj": "rajasthan", "sk": "sikkim", "tn": "tamil nadu", "tg": "telangana", "ts": "telangana",
    "tr": "tripura", "up": "uttar pradesh", "uk": "uttarakhand", "wb": "west bengal",
}

EXPANSIONS = STATES | ADDRESS_WORDS

COMMON_ADDRESS_WORDS = """
street road avenue boulevard drive court lane place circle way trail parkway highway
suite floor apartment building room number near opposite behind block sector phase
plot flat door fl no unit north south east west india us usa state district city
nagar colony bazaar marg gali null rd st ave blvd dr ct ln hwy apt ste first second
third ground
france rue r av bd chemin ch impasse imp allee all route rte cours crs quai qu pl
square sq voie passage pass cedex bp boite postale etage batiment bat immeuble
residence res lieu dit lieudit bis ter quater zone industrielle zi za activite de du
des la le les en au aux sur sous saint sainte d l
""".split()

# The cleaning steps (pattern, replacement), applied in this order to lower-case ASCII text.
CLEANING = (
    (r"https?://(?:www\.)?", ""),
    (r"\.(com|org|net|in|co|io|fr)\b", " "),
    (r"\b(?:no|#|num|numero)\b\.?", " "),
    (r"(\d+)\s*([a-zA-Z]+)", r"\1 \2"),
    (r"[^a-zA-Z0-9\s]", " "),
    (r"\s+", " "),
)
