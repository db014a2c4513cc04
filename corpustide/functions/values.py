"""Values that results depend on: names, limits, labels and formats of the data this engine reads. Fixed values, in natural order."""

# Facts compared between two states, and those of them that are written in the page's language.
FACTS = (
    "title", "status", "published", "ref", "link", "iub_uuid", "deadline", "opening", "docs_until", "consultation_until",
    "value", "currency", "buyer", "buyer_reg", "procedure", "profile", "legal_basis", "work_kind", "award_criteria",
    "cpv_main", "cpv_additional", "place", "lots", "framework", "contract_duration",
)
LOCALIZED = (
    "status", "procedure", "legal_basis", "work_kind", "award_criteria", "lots", "framework", "contract_duration", "deadline",
    "opening", "docs_until", "consultation_until"
)
RECORD_FIELDS = ("publish_date", "title", "type_code", "section", "withheld")
LANGUAGE_LABELS = (("lv", "Iepirkuma statuss"), ("en", "Procurement status"))

# Where a page shows a field: the platform's id, then labels. Names with an underscore are inputs only.
PAGE_FIELDS = {
    "ref": ("IdentificationNumber", "Iepirkuma identifikācijas numurs", "Identification number"),
    "title": ("Name", "Iepirkuma nosaukums", "Name"),
    "status": ("StatusInfo", "Iepirkuma statuss", "Procurement status"),
    "published": (
        "FirstAnnouncementDate", "Izsludināts", "Announced", "Izsludināts / publicēts", "Izsludināšanas / publicēšanas datums",
        "Announced / Published", "Announcement / Publication date"
    ),
    "procedure": ("ProcurementRegulationId", "Procedūras tips", "Procedure / procurement"),
    "profile": ("ProfileId", "Iepirkuma profils", "Procurement profile"),
    "legal_basis": ("RegulatoryActId", "Procedūras juridiskais pamats", "Regulatory LA"),
    "work_kind": ("SubjectDescription_ProcurementObjectTypeId", "Pamatveids", "Object type"),
    "deadline": ("stage_ProposalSubmissionDate", "Pieteikumu/piedāvājumu iesniegšanas termiņš", "Applications / proposals submission deadline"),
    "opening": ("stage_ProposalOpeningDate", "Pieteikumu/piedāvājumu atvēršanas laiks", "Applications / proposals opening"),
    "docs_until": ("stage_DocumentationAvailabilityDate", "Dokumentācijas izsniegšanas termiņš", "Documentation issuance deadline"),
    "consultation_until": ("stage_SuppliersGathering", "Apspriedes ar piegādātājiem termiņš", "Deadline for consultation with suppliers"),
    "cpv_main": ("SubjectDescription_CpvMainId", "CPV galvenais kods", "CPV main code"),
    "place": ("SubjectDescription_ShipmentAddress", "Līguma izpildes vieta", "Execution place"),
    "lots": ("SubjectDescription_ProcurementHasParts", "Iepirkums ir sadalīts daļās", "Procurement is split into lots"),
    "framework": ("SubjectDescription_IsGeneralAgreement", "Paredzēta vispārīgā vienošanās", "Framework agreement intended"),
    "contract_duration": ("SubjectDescription_ContractDuration", "Līguma darbības termiņš", "Performance of the contract"),
    "award_criteria": ("ProposalSelectionMethodId", "Izvēles metode", "Award criteria"),
    "_buyer": ("OrganizerId", "Organizācijas nosaukums", "Contracting authority"),
    "_cpv_extra": ("SubjectDescription_CpvAdditionalIdList", "CPV papildkods", "CPV additional code"),
    "_value": ("SubjectDescription_EstimatedContractValue", "Paredzamā vērtība", "Expected contract price"),
}
BUYER_SPLIT = ", reģ. numurs:"
PERSONAL_LABEL = "kontakt|e-?past|t[āa]lru|person"
CURRENT_ARRAY, ARCHIVE_ARRAY, CODES_ARRAY = "ActualDocuments_items", "HistoricalDocuments_items", "CpvAdditionals_items"
PUBLISHED_STRUCTURE = ("__RequestVerificationToken", "ActualDocuments_items")
PUBLISHED_HEADINGS = ("Iepirkuma pamatdati", "Basic data")
DENIED_HEADINGS = ("Pieeja liegta / Access Denied",)
ROBOT_HEADINGS = ("Pārbaude pret robotiem",)
DEFAULT_LINK_TYPE = "PRCDOC"

# Addresses of the register and the platform, as patterns and templates.
NOTICE_UUID = r"https://eformsb\.pvs\.iub\.gov\.lv/show/([0-9a-f\-]{36})"
PLANNING_ID = r"https://eforms\.pvs\.iub\.gov\.lv/planning-publications/view/[a-z0-9\-]+/(\d+)"
PLATFORM_ID = r"eis\.gov\.lv/EKEIS/Supplier/Procurement/(\d+)"
PLATFORM_PAGE = "https://www.eis.gov.lv/EKEIS/Supplier/Procurement/"
PLATFORM_DOCUMENT = "https://www.eis.gov.lv/EKEIS/Document/"
NOTICE_PAGE = "https://eformsb.pvs.iub.gov.lv/show/"

# Register scan.
BIDDABLE = ("competition", "planning")
MAX_PAGES = 200
FRESHNESS_HOURS = 36

# Planning.
HEAVY_CODES = ("45", "71")
HEAVY_KINDS = ("būvdarbi", "construction")

# Scans for character recognition.
SCAN_REASONS = ("no text layer",)
SCAN_IMAGES = (".jpg", ".jpeg", ".png", ".tif", ".tiff", ".bmp")
DRAWINGS = (".dwg", ".dxf", ".emf", ".wmf")
INLINE_LIMIT = 14 * 1024 * 1024

# Extraction: how files begin, what tells containers apart, limits, and kinds of plain text.
FILE_STARTS = {".pdf": b"%PDF", ".ifc": b"ISO-10303-21", ".7z": b"7z", ".rtf": b"{\\rtf", ".zip": b"PK\x03\x04", ".ole": b"\xd0\xcf\x11\xe0"}
ZIP_PARTS = {".docx": "word/document.xml", ".xlsx": "xl/", ".pptx": "ppt/"}
OLE_STREAMS = {".doc": ("WordDocument",), ".xls": ("Workbook", "Book"), ".ppt": ("PowerPoint Document",)}
MAX_DEPTH, MAX_MEMBERS, MAX_EXPANDED = 6, 5000, 8 * 1024**3
MIN_USEFUL_CHARS = 1
TEXT_KINDS = {".txt": "text", ".csv": "csv", ".tsv": "tsv", ".xml": "xml", ".json": "json", ".md": "markdown"}
LEVEL_KEYS = ("start", "numFmt", "lvlText", "lvlRestart")
# A reason that later steps look for: such files are worth character recognition.
NO_TEXT = "no text layer — a scan or a vector drawing"

# Delivery.
DELIVERED_NAMES = (
    "manifest.json", "summary.json", "procurement.json", "manifest_normalized.json", "document.md", "structure.json", "done.txt",
    "failed.txt", "withdrawn.txt", "resolved.tsv"
)

# Pause between requests, in seconds: ceiling, floor, and per MiB received.
PAUSE_CAP, PAUSE_FLOOR, PAUSE_PER_MIB = 5.0, 0.75, 0.5
