"""Values that have to be exactly these for results to be right.

Everything here is data: names, codes, spellings and constants.
"""

from __future__ import annotations

# Raw voucher column name -> standard name.
COLUMN_NAMES = {
    "id": "id",
    "created_at": "created_at",
    "Name": "name",
    "연도": "year",
    "전표일자": "date",
    "부가세유형": "vat_type",
    "차변/대변": "dr_cr",
    "거래처코드": "party_code",
    "거래처명": "party_name",
    "계정과목코드": "acct_code",
    "적요번호": "desc_id",
    "적요명": "desc",
    "계정과목": "acct_name",
    "회사.회사명": "company_name",
    "회사.사업자등록번호": "vat_id_company",
    "매입.품명": "item",
    "매입.공급가액": "supply_amount",
    "매입.부가세": "vat_amount",
    "매입.합계금액": "total_amount",
    "매입.복수거래여부": "is_multi",
    "매입.전자여부": "is_electronic",
    "매입.불공제사유": "nondeductible_reason",
    "매입.봉사료": "service_charge",
    "매입.의제류구분": "deemed_code",
    "거래처유형코드": "party_type",
    "사업자등록번호": "vat_id_party",
    "수량": "quantity",
    "단가": "unit_price",
    "전표키": "journal_key",
    "상대.거래처코드": "counterparty_code",
    "상대.거래처명": "counterparty_name",
    "상대.계정과목코드": "counterparty_account_code",
    "상대.계정과목": "counterparty_account",
    "상대.카드번호": "card_number",
    "증빙코드": "document_type",
    "매출매입코드": "transaction_code",
    "전표키_카운팅": "journal_key_count",
    "batch_no": "batch_no",
    "업태": "business_type",
    "종목": "business_item",
    "과세유형메시지(코드)": "vat_message_code",
    "폐업일": "close_date",
    "과세유형전환일자": "vat_change_date",
    "세금계산서적용일자": "tax_invoice_apply_date",
    "변경젼과세유형메시지(코드)": "vat_message_code_previous",
    "업종코드": "business_code",
    "주요제품": "product",
    "기업구분": "entity_type",
    "회사.업태": "company_business_type",
    "회사.종목": "company_business_item",
    "회사.과세유형메시지(코드)": "vat_message_code_company",
    "회사.업종코드": "company_business_code",
    "회사.주요제품": "company_product",
    "회사.기업구분": "company_entity_type",
}

# VAT status code -> text, used for the party and for the company.
VAT_STATUS = {
    "1": "standard",
    "2": "simplified",
    "3": "special",
    "4": "exempt",
    "5": "nonprofit",
    "6": "nonvat",
    "7": "simplified_issuer",
    None: "unregistered",
    "None": "unregistered",
    "nan": "unregistered",
    "": "unregistered",
}

# Column -> code -> text. The key None says what NULL becomes.
CODE_TEXT = {
    "vat_message_code": VAT_STATUS,
    "vat_message_code_company": VAT_STATUS,
    "document_type": {
        "10": "tax_invoice",
        "11": "zero_invoice",
        "12": "exempt_invoice",
        "13": "import_invoice",
        "20": "credit_card",
        "21": "credit_card",
        "22": "credit_card",
        "30": "cash_receipt",
        "31": "cash_receipt",
        "32": "cash_receipt",
    },
    "party_type": {
        "11": "general_sale",
        "12": "general_purchase",
        "13": "general_both",
        "21": "financial_demand_deposit",
        "22": "financial_checking",
        "23": "financial_installment_savings",
        "24": "financial_time_deposit",
        "25": "financial_other",
        "26": "financial_foreign_currency",
        "31": "card_sale",
        "32": "card_purchase",
    },
    "transaction_code": {
        "1": "sale",
        "2": "purchase",
    },
}

# Account keywords per category; a later category wins over an earlier one.
TAX_KEYWORDS = {
    "income": ["revenue", "sales", "income"],
    "expense": ["cost", "expense", "overhead"],
    "asset": ["cash", "receivable", "inventory", "equipment"],
    "liability": ["payable", "loan", "debt"],
    "equity": ["capital", "retained", "stock"],
}

# Spellings of a missing value in field-per-column text.
MISSING_TEXT = ["", "nan", "NaN", "None", "<NA>"]
MISSING_TOKEN = "NULL"

# Spellings of a missing value in pattern-based text.
MISSING_PATTERNS = [
    "N/A", "NULL", "nan", "NaN", "null", "None", "none",
    "#N/A", "#DIV/0!", "<NA>", "NaT", "",
]

# Month and day of the public holidays that never move in South Korea.
FIXED_HOLIDAYS = [
    (1, 1), (3, 1), (5, 5), (6, 6), (8, 15), (10, 3), (10, 9), (12, 25),
]

# Upper ends of the token length bands, and their names.
TOKEN_BANDS = [
    ("0-50", 50),
    ("51-100", 100),
    ("101-200", 200),
    ("201-300", 300),
    ("301-400", 400),
    ("401-500", 500),
    ("500+", None),
]

# Code points that separate words (what Python's str.split() splits on).
WORD_SPACE = [
    *range(0x09, 0x0E), *range(0x1C, 0x20), 0x20, 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Fixed value: how far a float column may move when it is stored in single precision.
FLOAT_TOLERANCE = 5e-4
