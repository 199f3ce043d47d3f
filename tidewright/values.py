"""Word lists, patterns and formats that results depend on. Plain data, in natural order."""

PLACEHOLDER = "Not Provided"
MISSING = ["", "n/a", "na", "null", "none", "-", "?", "missing", "unknown", "nan"]
#: Strings that a CSV reader takes for null before anything else sees them.
CSV_NULLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

#: Header names of each semantic type.
ALIASES = {
    "email": ["email", "e-mail", "mail", "email_address", "e_mail", "emailaddress"],
    "phone": ["phone", "tel", "telephone", "mobile", "cell", "contact_number", "phone_number", "phonenumber"],
    "first_name": ["first_name", "firstname", "first", "fname", "given_name", "givenname"],
    "last_name": ["last_name", "lastname", "last", "lname", "surname", "family_name", "familyname"],
    "date": ["date", "join_date", "start_date", "created", "modified", "dob", "birthday", "hire_date", "end_date"],
    "company": ["company", "organization", "org", "employer", "firm", "business", "company_name"],
    "job_title": ["job_title", "title", "position", "role", "job", "designation", "jobtitle"],
}
#: Types whose value is also written under the canonical name.
CANONICAL = ["email", "phone", "first_name", "last_name", "job_title"]
PLACEHOLDER_FIELDS = ["email", "phone", "first_name", "last_name", "company", "job_title"]
NUMERIC_WORDS = ["age", "salary", "score", "rating", "count", "amount", "price", "cost"]
#: A column with one of these in its header is no phone, whatever its content looks like.
NOT_PHONE_WORDS = ["id", "code", "salary", "wage", "amount", "price", "cost", "score", "age"]

ACRONYMS = "HR CEO CFO COO CTO CIO CMO CRO CPO VP SVP EVP AVP IT KA BD R&D QA QC AI ML B2B B2C SaaS UX UI PR ROI KPI SEO SEM PMP CPA MBA PHD MD RN LPN".split()
SMALL_WORDS = "of and the a an in on at for to with by from".split()
#: Honorifics, removed in this order: those that may end in a full stop, and those that a space must follow.
HONORIFICS_STOP, HONORIFICS_SPACE = ["Dr", "Mr", "Mrs", "Ms", "Prof"], ["Sir", "Lady"]
TITLES_IN_NAMES = ["CEO", "CFO", "CTO", "VP", "PRESIDENT", "FOUNDER", "OWNER", "MANAGER", "DIRECTOR", "HEAD OF", "CHIEF"]
BUZZWORDS = ["ninja", "guru", "visionary", "rockstar", "wizard", "mom of"]

#: Code point ranges of emoji; the widest one also covers East Asian scripts.
EMOJI = [(0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF), (0x1F1E0, 0x1F1FF), (0x2702, 0x27B0), (0x24C2, 0x1F251), (0x1F900, 0x1F9FF), (0x1FA00, 0x1FA6F), (0x1FA70, 0x1FAFF), (0x2600, 0x26FF), (0xFE00, 0xFE0F), (0x200D, 0x200D)]
#: The same without East Asian scripts: enclosed letters, and enclosed ideographs.
EMOJI_ONLY = [r for r in EMOJI if r != (0x24C2, 0x1F251)] + [(0x24C2, 0x24FF), (0x1F100, 0x1F251)]

EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
EMAIL_STRICT = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
CURRENCY = r"^\s*'?\s*[\$€£¥₹]?\s*-?\d+(?:[\.,]\d+)?[KMBkmb]?\s*$"
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

DEDUP_FIELDS = ["email", "first_name", "last_name"]
#: Fields that a newer duplicate overwrites, and where its date is looked for, in this order.
MUTABLE = ["phone", "email", "address", "department", "salary", "status", "department_region", "performance_score", "remote_work"]
DATE_FIELDS = ["updated_at", "modified_at", "join_date", "created_at", "date"]

RULE_NULLS = ["nan", "none", "null", "n/a", "na", ""]
ID_COLUMNS = ["id", "employee_id", "employee id", "user_id", "user id", "legacy_id"]
FIRST_COLUMNS = ["name", "first_name", "last_name", "email", "phone", "job_title", "position", "company"]
RESERVED = ["run_id", "confidence_score", "failure_reason", "row_id", "status"]

MAX_FILE_BYTES = 50 * 1024 * 1024
ALLOWED_EXTENSIONS = [".csv", ".docx", ".db"]
HAZARDOUS_EXTENSIONS = ".exe .bat .sh .cmd .com .msi .scr .js .vbs .wsf .ps1 .jar .py .rb .dll .so .dylib".split()
SIGNATURES = {".docx": b"PK\x03\x04", ".db": b"SQLite format 3\x00", ".sqlite": b"SQLite format 3\x00"}
BYTE_PATTERNS = [b"MZ", b"\x7fELF", b"#!", b"powershell", b"Invoke-Expression", b"WScript.Shell", b"cmd.exe", b"<script", b"javascript:", b"data:text/html", b"vbscript:", b"DROP TABLE", b"DELETE FROM", b"TRUNCATE TABLE", b"'; --", b"OR 1=1"]
TEXT_PATTERNS = ["=cmd|", "=HYPERLINK(", "@SUM(", "IMPORTXML("]
MACRO_PARTS = ["vbaproject.bin", "vbadata.xml", ".vbs", ".js", "oleobject"]
