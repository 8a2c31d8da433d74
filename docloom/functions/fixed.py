"""Keys, sentinels, word lists and patterns of the archive format. Results depend on them as they are."""

# Front-matter keys.
KEYS = {
    "message_id": "شناسه",
    "subject": "موضوع",
    "sender": "فرستنده",
    "to": "گیرنده اصلی (To)",
    "cc": "رونوشت (Cc)",
    "jalali_date": "تاریخ شمسی",
    "source_name": "منبع",
    "n_attachments": "تعداد پیوست‌های معتبر ذخیره شده",
    "attachments": "پیوست‌ها",
    "folder": "مسیر پوشه",
    "doc_kind": "نوع سند",
    "conv_id": "شناسه گفتگو",
    "n_messages": "تعداد کل پیام‌ها",
    "date_range": "بازه زمانی شمسی",
    "participants": "مشارکت‌کنندگان",
    "parent_email": "ایمیل والد",
    "source_file": "فایل منبع",
    "attachment_name": "پیوست",
    "kind": "نوع",
    "notes": "یادداشت",
    "parents": "ایمیل‌های مرتبط (والد)",
    "coverage": "پوشش",
    "original_path": "فایل_اصلی",
    "rag_ready": "آماده_RAG",
    "ocr_quality": "کیفیت_OCR",
    "policy": "سیاست_پذیرش",
    "pages_total": "تعداد_صفحات_اصلی",
    "pages_processed": "تعداد_صفحات_پردازش‌شده",
    "pages_range": "صفحات_پردازش‌شده",
    "complete": "پردازش_کامل",
}

# Sentinels.
NO_SUBJECT = "(بدون موضوع)"
NO_THREAD_SUBJECT = "بدون موضوع"
UNKNOWN = "نامشخص"
NONE = "ندارد"
EMPTY_BODY = "فاقد پیام متنی مهم"
NO_TEXT_BODY = "_(بدون محتوای متنی)_"
DEFAULT_DATE = "1402/01/01"
NO_NAME = "No_Subject"
EMAIL_FIRST = "email_first_v1"
NO_EXTRACTABLE_TEXT = ("بدون متن قابل استخراج", "نیاز به OCR")

# Section titles of thread documents.
LATEST_TITLE = "### 📩 آخرین پیام (پاسخ جاری):"
HISTORY_TITLE = "### 📜 پیام در تاریخچه مکاتبات:"

# Attachments.
VALID_EXTENSIONS = (
    ".pdf", ".docx", ".doc", ".xlsx", ".xls", ".xlsm", ".pptx", ".rar", ".zip", ".dwg", ".jpg", ".jpeg", ".png",
    ".bmp", ".tif", ".tiff", ".msg", ".txt", ".csv",
)
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff")
OFFICE_EXTENSIONS = (".xlsx", ".xlsm", ".xls", ".docx", ".pptx")
OCR_EXTENSIONS = (".pdf", ".doc", ".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff")
INLINE_WORDS = ("image", "signature", "logo")
INLINE_IMAGE_BYTES = 40 * 1024
PHOTO_PREFIXES = ("img_", "img-", "dsc_", "2024", "2023", "2025", "pic_")
NOISE_WORDS = ("logo", "signature", "avatar", "outlookemoji", "image00")

# Pages and chunks.
PAGE_LIMIT, SIZE_LIMIT_MB, PREVIEW_PAGES = 15, 10, 5
CHUNK_CHARS, MIN_SECTION_CHARS = 1200, 15
SHEET_ROWS, SHEET_COLUMNS = 1000, 40
BUNDLE_WORDS, BUNDLE_BYTES = 200_000, 50_000_000

# Text quality.
TABLE_WORDS = ("DWG", "LENGTH", "DIFF", "PACKING", "IRN", "COLUMNS", "MATERIAL", "شرح", "تعداد", "واحد")
ANCHORS = (
    "Packing List", "BOLT GAL", "CASING", "INSPECTION RELEASE NOTE", "REPORT NO", "DWG NO", "DIAGONAL", "PLUMBNESS",
    "CALIBRATION", "MATERIAL NO", "NET WEIGHT", "QTY", "MANUFACTURER NAME",
)
CRITICAL_ANCHOR = "CALIBRATION"
PERSIAN_WORDS = tuple(
    "است این آن برای شماره گزارش شرکت درخواست نمونه تاریخ نتیجه نتایج بررسی آزمون مطابق مورد شده صفحه تعداد شرح واحد"
    " پیچ مهره بویلر نیروگاه شکست اتصال".split()
)
ENGLISH_WORDS = tuple(
    "the a an and of to in is are for with on by from this that as be at or no report page test inspection material"
    " bolt nut casing length weight quantity project sample date number".split()
)
OCR_WARNING = (
    "> هشدار اعتبار متن: این متن با OCR از تصویر صفحه استخراج شده است. کلمات، اعداد و مفهوم ممکن است نادرست منتقل شده"
    " باشند؛ خطا در نوشته‌های دست‌نویس فارسی می‌تواند بسیار شدید باشد. برای نتیجه‌گیری حساس به اصل پیوست مراجعه کنید."
    " نوع نوشتار و درصد دقت تأیید نشده است."
)

# Patterns of message cleaning.
STRONG_NOISE = (
    r"[-_]{3,}",
    r"tel\s*:\s*\+?\d+",
    r"fax\s*:\s*\+?\d+",
    r"phone\s*:\s*\(?\+?\d+",
    r"mobile\s*:",
    r"^\+?\d[\d\s\-\(\)]{7,}$",
    r"(?:^|\s)تلفن\s*$",
    r"(?:^|\s)فکس\s*$",
    r"تلفن[^:]{0,12}\s*:",
    r"فکس[^:]{0,12}\s*:",
    r"همراه\s*:",
    r"\d{2,6}\s*:?\s*داخلی\s*$",
    r"^داخلی\s*:?\s*\d{2,6}",
    r"p\.?o\.?\s*box",
    r"postal\s*code",
    r"کدپستی",
    r"website\s*:?",
    r"www\.[a-zA-Z0-9\.\-]+",
    r"this communication contains information",
    r"confidentiality notice",
    r"confidential",
    r"privileged",
    r"liability",
    r"exclusive use",
    r"addressee",
    r"prohibited",
    r"composer",
    r"این پیام و فایل.*محرمانه",
    r"کد\s*رفتاری",
    r"هشدار\s*امنیتی",
    r"please consider the environment",
    r"در\s*صورت\s*لزوم\s*پرینت",
    r"no\.\s*\d+",
    r"\bco\.\s*$",
    r"office\s*:",
    r"factory\s*:",
    r"تهران[^،\n]*[،,]\s*(?:بزرگراه|بلوار|خیابان)",
    r"(?:بزرگراه|بلوار|خیابان)[^،\n]*[،,]\s*تهران",
)
WEAK_NOISE = (r"تهران،", r"خیابان", r"بزرگراه", r"بلوار")
BANNERS = (
    r"هشدار\s*امنیتی",
    r"از\s*خارج\s*سازمان",
    "باز\\s*کردن\\s*فایل‌های?\\s*پیوست",
    r"سامانه\s*خدمات\s*IT",
    r"WARNING\s*:",
    r"ATTACHMENT\s*UNSCANNED",
    r"CAUTION\s*:",
    r"external\s*sender",
    r"کد\s*(?:رفتاری|شماره\s*\d+)",
    r"باشگاه\s*کتابخوانی",
    r"حمایت\s*از\s*نوآوری",
    r"دامنه\s*ایمیل",
    r"email\s*domain",
    r"new\s*domain",
)
BANNER_LINES = (*BANNERS, r"چنانچه\s*فرستنده", r"از\s*باز\s*کردن", r"خودداری\s*کرده")
VALEDICTIONS = (
    r"^(?:با\s*تشکر|باتشکر|با\s*سپاس|باسپاس)(?:\s*[-–—]\s*.*)?\s*$",
    r"^با\s*تجدید\s*احترام(?:\s*[-–—]\s*.*)?\s*$",
)
GREETINGS = (r"^با\s*سلام\b", r"^باسلام\b", r"^سلام\s*علیکم", r"^سلام[,،!]?\s*$", r"^با\s*درود", r"^بادرود")
TITLES = (
    "^(?:(?:جناب|سرکار|آقای|خانم|مهندس|دکتر|همکار)(?![؀-ۿ])"
    "[\\s‌]*(?:گرامی|محترم)?[\\s‌]*[/،,\\\\]?[\\s‌]*)+"
)
MIDDLE_TITLES = "[-–—/]\\s*(?:جناب|سرکار)[\\s‌]+(?:آقای|خانم)[\\s‌]+(?:مهندس|دکتر)[\\s‌]+"
COURTESY = "^احترامـ*اً?([،,]\\s*|\\s+|$)"
BULLET = r"^\s*(\d+[\.\-)]|\*|-|•)\s+\S"
SIGNATURE_WORDS = (
    r"شرکت|company|co\.|corp|expert|کارشناس|مدیر|manager|engineer|engineering|پروژه|project|dept|department|office|دفتر|"
    r"senior|lead|supervisor"
)
# A line that is a job title: bounds of its characters and words, what it has, and what it has not.
SIGNATURE_TITLE = {"chars": (45, 80), "words": (1, 7), "with": SIGNATURE_WORDS, "without": "[،,.!؟?؛:]"}
SUBJECT_WARNING = r"\[WARNING[^\]]*\]\s*"
SUBJECT_PREFIXES = r"^(?:(?:re|fw|fwd|پاسخ|بازفرست)\s*[:：]\s*|\s*\[warning[^\]]*\]\s*)+"
MAIL_LINKS = (r"[<\[](?i:mailto):[^>\]]*[>\]]", r"<[^<>\n]*?@[^<>\n]*?>", r"<(?i:https?)://[^>]*>", r"<\s*>")
THREAD_HEADER = r"(?m)^(?:\s*[-_]{2,}\s*)?^(From:|از:)"
QUOTE_HEADER = r"(?mi)^(?:\s*[-_]{2,}\s*)?(?:>\s*)?(?:From:|از:)"
HEADER_FIELDS = (
    "From:", "از:", "Sent:", "ارسال:", "فرستاده شده:", "To:", "به:", "Cc:", "رونوشت:", "Subject:", "موضوع:",
)
COPY_FIELDS = ("cc:", "رونوشت:")
PERSIAN_MONTHS = (
    "فروردین", "اردیبهشت", "خرداد", "تیر", "مرداد", "شهریور", "مهر", "آبان", "آذر", "دی", "بهمن", "اسفند",
)
SENT_LINE = r"^(?i:Sent|Date|ارسال|فرستاده شده)\s*:\s*(.*)$"
SENT_FORMATS = (
    "MMMM d, yyyy h:mm a", "MMM d, yyyy h:mm a", "d/MMM/yyyy h:mm a", "d/MMMM/yyyy h:mm a", "d MMM yyyy h:mm a",
    "MMMM d, yyyy H:mm", "d/MMM/yyyy H:mm", "yyyy-M-d H:mm",
)
# The same for strptime.
SENT_FORMATS_PYTHON = (
    "%B %d, %Y %I:%M %p", "%b %d, %Y %I:%M %p", "%d/%b/%Y %I:%M %p", "%d/%B/%Y %I:%M %p", "%d %b %Y %I:%M %p",
    "%B %d, %Y %H:%M", "%d/%b/%Y %H:%M", "%Y-%m-%d %H:%M",
)

# Marks that a page's text stands between.
PAGE_MARK = r"(?i)RAGPAGE\s*([0-9]{4})\s*(BEGIN|END)"

# References in reports.
REFERENCE = r"(?i)(?<![\p{L}\p{N}_])(?:E-[0-9a-f]{20}|A-[0-9a-f]{20}(?:-T-[0-9a-f]{12})?)(?![\p{L}\p{N}_])"
# Codes of letters and drawings are each archive's own; these are examples of their usual form.
CORRESPONDENCE_CODES = r"(?i)\b[A-Z]{3,5}-\d+\b"
DRAWING_CODES = r"\b[A-Z]{2}\d-[A-Za-z0-9.-]+"
