"""Fixed values the results depend on.

FIXED VALUES -- these must equal the survey rules of the original pipeline for
results to match; they are stated here plainly, in their natural order, and
every operator reads them from here (callers may pass their own).
"""

from __future__ import annotations

from decimal import Decimal

# ---- FIXED VALUES: validation patterns (POSIX-style, anchored) ----
DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DATE_PREFIX_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
UNITS_RE = r"^[0-9]+$"
COORD_RE = r"^-?[0-9]+\.?[0-9]*$"
RENT_RE = r"^[0-9]+\.?[0-9]*$"
AMOUNT_RE = r"^[0-9]+\.?[0-9]*$"
TIN_RE = r"^[0-9]{10}$"
MOBILE_RE = r"^(\+220|220)?[0-9]{7,8}$"
EMAIL_RE = r"^[A-Za-z0-9._%-]+@[A-Za-z0-9.-]+[.][A-Za-z]+$"
NIN_RE = r"^[0-9]{9}$"

# ---- FIXED VALUES: ranges ----
UNITS_MIN, UNITS_MAX, UNITS_DEFAULT = 1, 1000, 1
LAT_MIN, LAT_MAX = Decimal("13.0"), Decimal("13.9")
LON_MIN, LON_MAX = Decimal("-17.0"), Decimal("-13.5")
RENT_MAX = Decimal("10000000")
DOB_MIN = "1900-01-01"

# ---- FIXED VALUES: normalisation synonyms (lower(trim(x)) in list -> value), then default ----
CURRENCY_SYNONYMS = {
    "dalasi": ["dalasi", "gmd"],
    "usd": ["usd", "dollar", "$"],
    "euro": ["euro", "eur", "€"],
    "pounds": ["pound", "pounds", "gbp", "£"],
}
CURRENCY_DEFAULT = "dalasi"
PROPERTY_USE_SYNONYMS = {
    "place-of-business": ["place-of-business", "commercial", "business", "shop", "office"],
    "residence": ["residence", "residential", "home", "apartment"],
}
PROPERTY_USE_DEFAULT = "residence"
BASIS_SYNONYMS = {
    "owner": ["owner", "proprietor"],
    "landlord": ["landlord", "agent"],
    "occupant": ["occupant", "tenant", "renter"],
}
BASIS_DEFAULT = "occupant"

# ---- FIXED VALUES: money ----
RATES_TO_GMD = {"dalasi": Decimal("1.00"), "euro": Decimal("76.92"), "usd": Decimal("71.43"),
                "pounds": Decimal("90.91")}
TAX_RATES = {"commercial": Decimal("0.15"), "residential_rental": Decimal("0.08"), "business": Decimal("0.27")}
MONEY_OVERFLOW_TEXT = "###,###,###.##"
MONEY_OVERFLOW_AT = Decimal("1000000000")

# ---- FIXED VALUES: data quality points ----
QUALITY_POINTS = {"first_name": 10, "gender": 10, "dob": 15, "mobile_1": 15, "tin": 20, "geo": 10, "rent": 20}

# ---- FIXED VALUES: display labels (exact match -> label; otherwise the noted default) ----
BASIS_LABELS = {"owner": "Owner", "landlord": "Agent/landlord", "occupant": "Occupant"}  # else initcap
TYPE_LABELS = {"individual": "Individual", "corporate": "Corporate/Government"}  # else initcap
TAX_REGISTERED_LABELS = {"yes": "Yes", "no": "No", "not_sure": "Not sure"}  # else initcap
BUILDING_TYPE_LABELS = {"apartment_complex": "Apartment Complex", "residence": "Residence",
                        "business": "Business", "residence_business": "Residence/Business"}  # else initcap, 'Not Specified'
OCCUPANCY_BASIS_LABELS = {"rent_lease": "Rent/Lease", "family_compound": "Rent Free - family compound",
                          "rent_free": "Rent free - other, not family"}  # else initcap
GENDER_LABELS = {"male": "Male", "female": "Female", "other": "Other"}  # on lower(x); else initcap
ID_TYPE_LABELS = {"national_id": "National ID", "passport": "Passport", "drivers_license": "Drivers License"}
PRESENCE_LABELS = {"occupant": "This person occupies a unit",
                   "remote": "This person manages or owns the property from elsewhere"}  # else initcap
PROPERTY_USE_LABELS = {"residence": "Residence", "place-of-business": "Place of Business"}  # else initcap
PAYMENT_FREQUENCY_LABELS = {"monthly": "Monthly", "quarterly": "Quarterly", "semi_annually": "Semi-Annually",
                            "annually": "Annually"}  # else initcap
CURRENCY_LABELS = {"dalasi": "Dalasi", "usd": "USD", "pounds": "Pounds", "euro": "Euro"}  # else upper
PAYMENT_METHOD_LABELS = {"local_bank": "Local Bank", "foreign_bank": "Foreign Bank", "cash": "Cash",
                         "mobile_money": "Mobile Money"}  # else initcap
FOLLOW_UP_LABELS = {"meeting_scheduled": "Meeting Scheduled", "pending": "Pending",
                    "reported_paid": "Reported and paid"}  # else initcap, 'New'
REVIEW_STATE_LABELS = {"pending": "Pending", "approved": "Approved", "rejected": "Rejected",
                       "hasIssues": "Has Issues", "edited": "Edited", "received": "Received"}  # else initcap, 'Pending'
TIN_STATUS = ("Valid TIN", "TIN Provided (Needs Validation)", "No TIN")
OWNER_FLAG = ("Owner", "No Owner")
REJECTED_FLAG = ("EXCLUDE", "INCLUDE")
FOLLOW_UP_DEFAULT = "New"
REVIEW_STATE_DEFAULT = "Pending"
FORM_VERSION_DEFAULT = "1.0"
BUILDING_TYPE_DEFAULT = "Not Specified"

# ---- FIXED VALUES: URL report statuses and refresh rule ----
URL_STATUS = {"none": "Sin fecha de vencimiento", "expired": "VENCIDA", "soon": "PRÓXIMA A VENCER",
              "valid": "VÁLIDA"}
REFRESH_THRESHOLD_HOURS = 2
EXPIRES_RE = r"Expires=(\d+)"
IMG_SRC_RE = r"src=[\"']([^\"']+)[\"']"
SMALL_PAYLOAD_BYTES = 100
DECODE_MAX_ROUNDS = 10
SIGNED_URL_SECONDS = 86400

# ---- FIXED VALUES: storage layout for attachments ----
ATTACHMENT_BASE_FOLDER = "odk_images"
ATTACHMENT_FOLDERS = {"building_image": "building-images", "address_plus_code": "address-plus-code-images"}
ATTACHMENT_DEFAULT_FOLDER = "building-images"
PLACEHOLDER_FOLDER = "placeholders"

# ---- FIXED VALUES: sync bookkeeping ----
SYNC_TYPES = ("main_submissions", "person_details", "image_processing", "url_refresh")
SYNC_STATUSES = ("in_progress", "success", "error")
HISTORY_RETENTION_DAYS = 30
ERROR_TEXT_MAX = 1000
RECENT_ATTEMPTS = 10
QUALITY_GOOD_SCORE = 80
RESULT_ROW_LIMIT = 50000

# ---- FIXED VALUES: image HTML of the nested-input variant (a grey square placeholder) ----
NESTED_BUILDING_IMAGE_HTML = '<img src="data:image/svg+xml;base64,PHN2ZyB3aWR0aD0iMTAwIiBoZWlnaHQ9IjEwMCI+PHJlY3Qgd2lkdGg9IjEwMCIgaGVpZ2h0PSIxMDAiIGZpbGw9IiNkZGQiLz48L3N2Zz4=" width="100" height="100" alt="Building">'

# Display-only defaults (parameters; neutral placeholders).
DEFAULT_FORM_URL = "https://odk.example.org/v1/projects/1/forms/survey"
STATIC_MAP_TEMPLATE = "https://maps.googleapis.com/maps/api/staticmap?center={}&zoom=15&size=100x100&key=YOUR_API_KEY"
