"""Word lists, lookup tables, patterns and defaults that results depend on."""

# Nicknames of the master matcher.
NICKNAMES = {
    "BILL": "WILLIAM", "BILLY": "WILLIAM", "WILL": "WILLIAM", "WILLY": "WILLIAM", "WILLIE": "WILLIAM", "LIAM": "WILLIAM",
    "BOB": "ROBERT", "BOBBY": "ROBERT", "ROB": "ROBERT", "ROBBIE": "ROBERT",
    "CHUCK": "CHARLES", "CHARLIE": "CHARLES", "CHAS": "CHARLES",
    "DICK": "RICHARD", "RICK": "RICHARD", "RICH": "RICHARD", "RICKY": "RICHARD",
    "MIKE": "MICHAEL", "MIKEY": "MICHAEL",
    "JIM": "JAMES", "JIMMY": "JAMES", "JIMMIE": "JAMES", "JAMIE": "JAMES",
    "TOM": "THOMAS", "TOMMY": "THOMAS", "JACK": "JOHN", "JOHNNY": "JOHN", "JON": "JOHN", "JOE": "JOSEPH", "JOEY": "JOSEPH",
    "ED": "EDWARD", "EDDIE": "EDWARD", "TED": "EDWARD", "TEDDY": "EDWARD", "DAN": "DANIEL", "DANNY": "DANIEL",
    "DAVE": "DAVID", "DAVY": "DAVID", "STEVE": "STEVEN", "STEVIE": "STEVEN", "STEPHEN": "STEVEN", "PAT": "PATRICK",
    "TONY": "ANTHONY", "LARRY": "LAWRENCE", "LARS": "LAWRENCE", "HARRY": "HAROLD", "HAL": "HAROLD",
    "JERRY": "GERALD", "GERRY": "GERALD", "TERRY": "TERRENCE", "MATT": "MATTHEW", "ANDY": "ANDREW", "DREW": "ANDREW",
    "FRED": "FREDERICK", "FREDDY": "FREDERICK", "SAM": "SAMUEL", "SAMMY": "SAMUEL", "BEN": "BENJAMIN", "BENNY": "BENJAMIN",
    "KEN": "KENNETH", "KENNY": "KENNETH", "RON": "RONALD", "RONNIE": "RONALD", "DON": "DONALD", "DONNIE": "DONALD",
    "PETE": "PETER", "NICK": "NICHOLAS", "WALT": "WALTER", "WALLY": "WALTER", "HANK": "HENRY", "RAY": "RAYMOND",
    "PHIL": "PHILIP", "PHILLIP": "PHILIP", "DOUG": "DOUGLAS", "GREG": "GREGORY", "JEFF": "JEFFREY", "GEOFF": "JEFFREY",
    "GENE": "EUGENE", "ART": "ARTHUR", "VIC": "VICTOR", "VINCE": "VINCENT", "VINNY": "VINCENT", "STAN": "STANLEY",
    "HERB": "HERBERT", "LOU": "LOUIS", "BERNIE": "BERNARD", "MARTY": "MARTIN", "NORM": "NORMAN", "LENNY": "LEONARD",
    "LEO": "LEONARD", "AL": "ALBERT", "ALEX": "ALEXANDER", "CHRIS": "CHRISTOPHER",
    "SANDY": "SANDRA", "SONDRA": "SANDRA", "DOLORES": "DELORES",
    "CATHY": "CATHERINE", "KATHY": "CATHERINE", "KATE": "CATHERINE", "KATIE": "CATHERINE", "KATHERINE": "CATHERINE", "KATHRYN": "CATHERINE",
    "BETTY": "ELIZABETH", "BETH": "ELIZABETH", "LIZ": "ELIZABETH", "LIZZY": "ELIZABETH", "ELIZA": "ELIZABETH",
    "PEGGY": "MARGARET", "PEG": "MARGARET", "MAGGIE": "MARGARET", "MARGE": "MARGARET", "MARGIE": "MARGARET",
    "SUE": "SUSAN", "SUZY": "SUSAN", "SUSIE": "SUSAN", "BARB": "BARBARA", "BARBIE": "BARBARA",
    "DEBBIE": "DEBORAH", "DEB": "DEBORAH", "DEBRA": "DEBORAH", "JENNY": "JENNIFER", "JEN": "JENNIFER",
    "SALLY": "SARAH", "SAL": "SARAH", "TINA": "CHRISTINA", "VICKY": "VICTORIA", "VIKKI": "VICTORIA", "CONNIE": "CONSTANCE",
    "DOTTY": "DOROTHY", "DOT": "DOROTHY", "FRAN": "FRANCES", "GINNY": "VIRGINIA", "JUDY": "JUDITH", "MILLIE": "MILDRED",
    "NELL": "HELEN", "NELLIE": "HELEN", "PATTY": "PATRICIA", "PATSY": "PATRICIA", "TRISH": "PATRICIA",
}
BUSINESS_SUFFIXES = ["LLC", "INC", "CORP", "CO", "LTD", "LP", "LC", "LLP", "PARTNERSHIP", "PARTNE", "PARTNERSHP", "COMPANY"]
BUSINESS_DESCRIPTORS = ["SERVICES", "HOLDINGS", "INVESTMENT", "INVESTMENTS"]
INDUSTRY_TERMS = [
    "EXPLORATION", "DRILLING", "PRODUCTION", "PETROLEUM", "ENERGY", "RESOURCES", "OPERATING", "PIPELINE", "MIDSTREAM",
    "UPSTREAM", "DOWNSTREAM", "MINERALS", "ROYALTIES", "PROPERTIES", "OIL", "GAS", "NATURAL",
]
NAME_SUFFIXES = ["JR", "SR", "II", "III", "IV", "V"]
NUMBER_WORDS = {"ONE": "1", "TWO": "2", "THREE": "3", "FOUR": "4", "FIVE": "5", "SIX": "6", "SEVEN": "7", "EIGHT": "8", "NINE": "9", "TEN": "10"}
STATES = {
    "AL": "ALABAMA", "AK": "ALASKA", "AZ": "ARIZONA", "AR": "ARKANSAS", "CA": "CALIFORNIA", "CT": "CONNECTICUT",
    "DE": "DELAWARE", "FL": "FLORIDA", "GA": "GEORGIA", "HI": "HAWAII", "ID": "IDAHO", "IL": "ILLINOIS", "IA": "IOWA",
    "KS": "KANSAS", "KY": "KENTUCKY", "LA": "LOUISIANA", "ME": "MAINE", "MD": "MARYLAND", "MA": "MASSACHUSETTS",
    "MI": "MICHIGAN", "MN": "MINNESOTA", "MS": "MISSISSIPPI", "MO": "MISSOURI", "MT": "MONTANA", "NE": "NEBRASKA",
    "NV": "NEVADA", "NH": "NEWHAMPSHIRE", "NJ": "NEWJERSEY", "NM": "NEWMEXICO", "NY": "NEWYORK", "NC": "NORTHCAROLINA",
    "ND": "NORTHDAKOTA", "OH": "OHIO", "OK": "OKLAHOMA", "OR": "OREGON", "PA": "PENNSYLVANIA", "RI": "RHODEISLAND",
    "SC": "SOUTHCAROLINA", "SD": "SOUTHDAKOTA", "TN": "TENNESSEE", "TX": "TEXAS", "UT": "UTAH", "VT": "VERMONT",
    "VA": "VIRGINIA", "WA": "WASHINGTON", "WV": "WESTVIRGINIA", "WI": "WISCONSIN", "WY": "WYOMING", "DC": "DISTRICTOFCOLUMBIA",
}
BAD_SSNS = [str(d) * 9 for d in range(10)]
TRUST_KEYWORDS = [
    "TRUST", "TRUSTEE", "TRUSTEES", "TRUSTEESHIP", "TTEE", "LIVING TRUST", "FAMILY TRUST", "REVOCABLE TRUST",
    "IRREVOCABLE TRUST", "TESTAMENTARY", "ESTATE OF", "DECEDENT",
]

# Replacements in company and person names, in this order, whole words, any case.
NAME_RULES = [
    (r"FEDERAL\s+EXPRESS", "FEDEX"), (r"FEDEX\s+OFFICE", "FEDEX"),
    (r"NEW\s+HAMPSHIRE", "NEWHAMPSHIRE"), (r"NEW\s+JERSEY", "NEWJERSEY"), (r"NEW\s+MEXICO", "NEWMEXICO"), (r"NEW\s+YORK", "NEWYORK"),
    (r"NORTH\s+CAROLINA", "NORTHCAROLINA"), (r"NORTH\s+DAKOTA", "NORTHDAKOTA"), (r"SOUTH\s+CAROLINA", "SOUTHCAROLINA"),
    (r"SOUTH\s+DAKOTA", "SOUTHDAKOTA"), (r"WEST\s+VIRGINIA", "WESTVIRGINIA"), (r"RHODE\s+ISLAND", "RHODEISLAND"),
    (r"DISTRICT\s+OF\s+COLUMBIA", "DISTRICTOFCOLUMBIA"),
    (r"LIV\s+TR", "LIVING TRUST"), ("REVOC", "REVOCABLE"), ("REV", "REVOCABLE"), ("TR", "TRUST"),
    ("JUNIOR", "JR"), ("SENIOR", "SR"), ("THIRD", "III"), ("FOURTH", "IV"), ("SECOND", "II"),
    ("CORPORATION", "CORP"), ("INCORPORATED", "INC"), ("COMPANY", "CO"), ("LIMITED", "LTD"),
    (r"L\s*L\s*C", "LLC"), (r"L\s*C", "LC"), (r"L\s*P", "LP"),
]
ROMAN_SPLIT = r"([A-Za-z]{2,})(III|IV|II)"

MONTHS = "(?:JAN(?:UARY)?|FEB(?:RUARY)?|MAR(?:CH)?|APR(?:IL)?|MAY|JUNE?|JULY?|AUG(?:UST)?|SEP(?:T(?:EMBER)?)?|OCT(?:OBER)?|NOV(?:EMBER)?|DEC(?:EMBER)?)"
WORD_DATES = rf"\b{MONTHS}[\s,]+\d{{1,2}}[\s,]+\d{{2,4}}\b|\b\d{{1,2}}[\s,]+{MONTHS}[\s,]+\d{{2,4}}\b|\b{MONTHS}[\s,]+\d{{4}}\b"
NUMBER_DATES = r"\b\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}\b"
ANY_DATES = rf"(?i){WORD_DATES}|\b\d{{1,2}}[/\-\s]\d{{1,2}}[/\-\s]\d{{2,4}}\b|\b\d{{8}}\b|\b(?:19|20)\d{{2}}\b|\b\d{{1,2}}[/\-]\d{{2,4}}\b"
UNKNOWN_ADDRESS = r"\b(?:UNKNOWN\s+ADDR(?:ESS)?|ADDR(?:ESS)?\s+UNKNOWN|NO\s+(?:VALID\s+)?ADDRESS|NOT\s+AVAILABLE)\b|^(?:NONE|N/?A|UNKNOWN)$"
UNKNOWN_TEXT = r"\b(?:UNKNOWN|NOT\s+AVAILABLE|N/?A)\b|^(?:NONE|UNKNOWN)$"

# Replacements in addresses of the master matcher, in this order.
BOX_WORDS = "ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN"
PO_BOX_RULES = [
    (r"\bPOST\s*OFFICE\s*BOX\b", "PO BOX"), (r"\bP\.?\s*O\.?\s*B\s*O\s*X\b", "PO BOX"), (r"\bP\.?\s*O\.?\s*B\b(?!\s*O)", "PO BOX"),
    (r"\bPOB\b", "PO BOX"), (r"\bPOP\s+BOX\b", "PO BOX"), (r"\bPO\s+BOX\s*#", "PO BOX "),
]
COUNTY_ROADS = [(r"\bCOUNTY\s+ROAD\b", "CR"), (r"\bCOUNTY\s+RD\b", "CR")]
STREET_WORDS = [
    ("NORTHEAST", "NE"), ("NORTHWEST", "NW"), ("SOUTHEAST", "SE"), ("SOUTHWEST", "SW"), ("NORTH", "N"), ("SOUTH", "S"), ("EAST", "E"), ("WEST", "W"),
    ("STREET", "ST"), ("AVENUE", "AVE"), ("BOULEVARD", "BLVD"), ("DRIVE", "DR"), ("ROAD", "RD"), ("LANE", "LN"), ("COURT", "CT"), ("CIRCLE", "CIR"),
    ("PLACE", "PL"), ("HIGHWAY", "HWY"), ("PARKWAY", "PKWY"), ("TERRACE", "TER"), ("TRAIL", "TRL"),
    ("APARTMENT", "APT"), ("SUITE", "STE"), ("BUILDING", "BLDG"), ("FLOOR", "FL"), ("ROOM", "RM"),
]
NUMBER_SIGN = r"\b#\s*(\d+)\b"
ADDRESS_STARTS = ["HWY", "CR", "RR", "RT", "RTE", "ROUTE", "FM", "SH", "SR", "CMR", "PSC", "HC", "HCR", "STAR", "APT", "STE", "UNIT", "BLDG", "FL", "RM"]
STREET_TYPES = ["ST", "AVE", "BLVD", "DR", "RD", "LN", "CT", "CIR", "PL", "HWY", "PKWY", "TER", "TRL"]
DIRECTIONS = ["N", "S", "E", "W", "NE", "NW", "SE", "SW"]
UNITS = ["APT", "STE", "UNIT", "BLDG", "FL", "RM"]
CARE_OF = r"(?i)\bC\s*/?\s*O\s+(.+?)(?:\s{2,}|\s+\d|\s+P\s*\.?\s*O\s|\s+BOX\s|$)"
ATTENTION = r"(?i)\bATTN:?\s+(.+?)(?:\s{2,}|\s+\d|\s+P\s*\.?\s*O\s|\s+BOX\s|$)"
ROLES = r"(?i),?\s*(MANAGER|AGENT|DIRECTOR|TREASURER|SECRETARY|OFFICER|PRESIDENT|VP|VICE PRESIDENT|ADMINISTRATOR|SUPERVISOR)\s*$"

# (bucket, smallest and largest name score, smallest and largest address score): the defaults.
BUCKETS = [
    ("NEW BA AND NEW ADDRESS", 0, 0, 0, 0),
    ("EXISTING BA ADD NEW ADDRESS", 100, 100, 0, 0),
    ("EXISTING BA AND EXISTING ADDRESS", 100, 100, 100, 100),
]
NEEDS_REVIEW = "NEEDS REVIEW"

# Values of the record pipeline.
PIPELINE_ADDRESS_RULES = [
    (r"\bstreet\b", "st"), (r"\bstrt\b", "st"), (r"\bavenue\b", "ave"), (r"\bav\b", "ave"), (r"\bboulevard\b", "blvd"), (r"\bblv\b", "blvd"),
    (r"\bdrive\b", "dr"), (r"\broad\b", "rd"), (r"\blane\b", "ln"), (r"\bcourt\b", "ct"), (r"\bcircle\b", "cir"), (r"\bplace\b", "pl"),
    (r"\bparkway\b", "pkwy"), (r"\bapartment\b", "apt"), (r"\bsuite\b", "ste"), (r"\bnorth\b", "n"), (r"\bsouth\b", "s"), (r"\beast\b", "e"), (r"\bwest\b", "w"),
]
PIPELINE_NICKNAMES = {
    "tom": "thomas", "tommy": "thomas", "bill": "william", "billy": "william", "will": "william", "mike": "michael", "mikey": "michael",
    "tina": "christina", "chris": "christina", "christi": "christina", "bob": "robert", "bobby": "robert", "rob": "robert", "robby": "robert",
    "dick": "richard", "rick": "richard", "ricky": "richard", "rich": "richard", "jim": "james", "jimmy": "james", "jamie": "james",
    "dan": "daniel", "danny": "daniel", "dave": "david", "davey": "david", "joe": "joseph", "joey": "joseph",
    "beth": "elizabeth", "liz": "elizabeth", "lizzy": "elizabeth", "betty": "elizabeth", "jen": "jennifer", "jenny": "jennifer", "jenn": "jennifer",
    "matt": "matthew", "matty": "matthew", "andy": "andrew", "drew": "andrew", "tony": "anthony", "sue": "susan", "susie": "susan", "suzy": "susan",
}
GENERATIONS = {
    "junior": "jr", "jr.": "jr", "jr": "jr", "senior": "sr", "sr.": "sr", "sr": "sr", "ii": "2", "2nd": "2", "second": "2", "iii": "3", "3rd": "3", "third": "3",
    "iv": "4", "4th": "4", "fourth": "4", "v": "5", "5th": "5", "fifth": "5", "esq": "esq", "esq.": "esq", "esquire": "esq", "md": "md", "md.": "md",
    "phd": "phd", "phd.": "phd", "do": "do", "do.": "do", "dds": "dds", "dds.": "dds", "jd": "jd", "jd.": "jd",
}
TITLES = [
    "dr", "dr.", "doctor", "mr", "mr.", "mister", "mrs", "mrs.", "missus", "ms", "ms.", "miss", "prof", "prof.", "professor", "rev", "rev.", "reverend",
    "hon", "hon.", "honorable", "capt", "capt.", "captain", "lt", "lt.", "lieutenant", "sgt", "sgt.", "sergeant", "col", "col.", "colonel", "gen", "gen.", "general",
]
TRUST_MARKS = ["trust", "trustee", "revocable trust", "irrevocable trust", "living trust", "family trust", "estate of", "estate", "testamentary trust", "grantor trust"]
DEPARTMENT_MARKS = [
    "dept", "department", "division", "unit", "section", "radiology", "cardiology", "oncology", "emergency", "billing", "accounts payable",
    "accounts receivable", "hr", "human resources", "it dept", "laboratory", "pathology", "surgery", "anesthesiology", "pediatrics", "neurology",
    "orthopedics", "dermatology",
]
BUSINESS_MARKS = [
    "llc", "inc", "inc.", "incorporated", "corp", "corp.", "corporation", "ltd", "ltd.", "limited", "co", "co.", "company", "partnership", "lp", "l.p.", "llp",
    "l.l.p.", "pa", "p.a.", "pc", "p.c.", "pllc", "p.l.l.c.", "plc", "group", "associates", "partners",
]
SKIP_WORDS = ["dr", "the", "a", "an", "dba", "inc", "llc", "corp", "ltd"]

# Values of the name scripts with human review.
FLIP_SUFFIXES = [
    "LLC", "L.L.C", "LP", "L.P", "INC", "CORP", "LTD", "PLLC", "PC", "PA", "CORPORATION", "COMPANY", "CO", "INCORPORATED", "LIMITED", "LLP", "TRUST", "TR",
]
COMPANY_MARKS = [
    "PROPERTIES", "ASSOCIATES", "PARTNERS", "GROUP", "VENTURES", "HOLDINGS", "MANAGEMENT", "SERVICES", "ENERGY", "OIL", "GAS", "PETROLEUM", "MEDICAL",
    "HEALTH", "HOSPITAL", "CLINIC", "CARE",
]
KEY_SUFFIXES = ["LLC", "INC", "CORP", "LTD", "LP", "CORPORATION", "INCORPORATED", "COMPANY", "LIMITED", "CO"]
KEY_ABBREVIATIONS = [
    ("ASSOC", "ASSOCIATES"), ("ASSOCS", "ASSOCIATES"), ("GRP", "GROUP"), ("CTR", "CENTER"), ("CNTR", "CENTER"), ("HOSP", "HOSPITAL"), ("MED", "MEDICAL"),
    ("MGMT", "MANAGEMENT"), ("SVCS", "SERVICES"),
]
REVIEW_KEYWORDS = ["TRUST", "TRUSTEE", "TR ", "ESTATE", "DEPARTMENT", "DEPT", "DIVISION", "DIV"]
REVIEW_REASONS = {
    "TRUST": "Trust entities require verification - similar trust names may belong to different beneficiaries",
    "TRUSTEE": "Trustee roles require verification - multiple trustees may exist for same entity",
    "ESTATE": "Estate entities require verification - similar estate names may belong to different individuals",
    "DEPARTMENT": "Department names may be duplicated across different organizations",
    "DIVISION": "Division names may be duplicated across different organizations",
}
COMPLETENESS_FIELDS = ["address", "city", "state", "zip", "phone", "email", "contact_person"]
OPTIONAL_FIELDS = ["city", "state", "zip", "phone", "email", "contact_person", "notes"]

# Patterns of the master matcher's address rules.
DATED = r"\b(?:DATED|DTD)\s+"
HYPHENED_ORDINAL = r"\b(\d+)-(\d+(?:ST|ND|RD|TH)\b)"
BARE_BOX = rf"^\s*BOX\s*#?\s*(\d+|{BOX_WORDS})\s*$"
WORD_BOX = rf"\bPO\s*BOX\s+({BOX_WORDS})\b"
NUMBER_THEN_WORD = r"\b\d+\s+[A-Z]"
