"""Fixed values.

Every list, code, phrase, prior and threshold in this module has to equal the
published value for results to be right, so they are stated here as plain text,
together, and nowhere else.
"""

# --- Short-term disability -------------------------------------------------

STD_PRIOR_ORIGINAL = 0.00795
STD_PRIOR_TRAIN = 0.1792

STD_COLUMNS = [
    "Claim Identifier", "Received Date", "Loss Date", "Insured Gender",
    "Insured Age at Loss", "Insured Salary Ind", "Insured Hire Date",
    "Insured Zip", "Primary Diagnosis Category", "Duration Date",
    "Duration Months", "SIC Code", "Coverage Code", "Policy Termination Date",
    "Policy Effective Date", "Insured Annualized Salary", "Policy Lives",
]
STD_DATES = [
    "Received Date", "Loss Date", "Insured Hire Date", "Duration Date",
    "Policy Effective Date", "Policy Termination Date",
]
STD_NUMERIC = ["Insured Age at Loss", "Insured Annualized Salary", "Policy Lives"]
STD_CATEGORICAL = [
    "Insured Gender", "Insured Salary Ind", "Primary Diagnosis Category",
    "SIC_risk_ind", "Coverage Code",
]
STD_REQUIRED = [
    "Insured Age at Loss", "Insured Annualized Salary", "Policy Lives",
    "policy_tenure", "days_to_report", "emp_tenure", "prognosis_days",
    "Insured Gender", "Insured Salary Ind", "Primary Diagnosis Category",
    "Coverage Code", "SIC Code",
]
STD_DIAGNOSIS_GROUPS = [
    "UNKNOWN", "ILL-DEFINED CONDITIONS", "CONGENITAL ANOMALIES",
    "DISEASES OF THE BLOOD", "SKIN & SUBCUTANEOUS TISSUE",
    "RESPIRATORY SYSTEM", "NERVOUS SYSTEM & SENSE ORGANS",
    "MENTAL & NERVOUS DISORDERS",
]
STD_DIAGNOSIS_PREFIXES = [
    ("MENTAL, BEHAVIORAL & NEURO", "MENTAL & NERVOUS DISORDERS"),
    ("DISEASES OF THE NERVOUS SYSTEM", "NERVOUS SYSTEM & SENSE ORGANS"),
    ("DISEASES OF THE RESPIRATORY", "RESPIRATORY SYSTEM"),
    ("DISEASES OF THE SKIN & SUBCUTANEOUS", "SKIN & SUBCUTANEOUS TISSUE"),
    ("DISEASES OF THE BLOOD & BLOOD-FORMING", "DISEASES OF THE BLOOD"),
    ("CONGENITAL MALFORMATIONS, DEFORMATIONS", "CONGENITAL ANOMALIES"),
]
STD_SIC_HIGH = [
    "7371", "6321", "3548", "3444", "2731", "7514", "5063", "2297", "3751",
    "8231", "9531", "3586", "3823", "3672", "3271", "2865", "2399", "7819",
    "2841", "4011", "3561", "3363", "3629", "8999", "3366",
]
STD_SIC_MEDIUM = [
    "3841", "6371", "3549", "5722", "8222", "4522", "4111", "8631", "5122",
    "2022", "1623", "5141", "5641", "3496", "3731", "3674", "6411", "6153",
    "2821", "1521", "5944", "3545", "8621", "5099", "5015", "9224", "5072",
    "8042", "5311",
]
STD_COVERAGE_CORE = ["STD", "STDCORE", "STDBU", "STD1"]
STD_COVERAGE_VOLUNTARY = ["STDVOL", "VS1", "VS2"]

# --- Long-term disability --------------------------------------------------

LTD_COLUMNS = [
    "Claim Identifier", "Claim Cause Desc", "Claim State",
    "Claim Status Category", "Claim Status Code", "Coverage Code",
    "DOT Exertion Level (Primary)", "Eligibility Outcome", "Insured Gender",
    "Insured State", "Mental Nervous Ind", "Pre-Ex Outcome", "Occ Category",
    "Primary Diagnosis Category", "Primary Diagnosis Code",
    "Primary Diagnosis Desc", "SIC Category", "SS Adjustment Ind",
    "SS Eligible Ind", "SS Pursue Ind", "SS Reject Code",
    "Voc Rehab Active Status", "Voc Rehab Outcome", "First Payment From Date",
    "Last Payment To Date", "Duration Date", "Loss Date", "Insured Hire Date",
    "Policy Effective Date", "Policy Termination Date", "Received Date",
    "Insured Age at Loss", "Insured Annualized Salary", "Insured Salary Ind",
    "Policy Lives", "Duration Months",
]
LTD_DATES = [
    "First Payment From Date", "Last Payment To Date", "Duration Date",
    "Loss Date", "Insured Hire Date", "Policy Effective Date",
    "Policy Termination Date", "Received Date",
]
LTD_NUMERIC = [
    "Insured Age at Loss", "Insured Annualized Salary", "Policy Lives",
    "Duration Months",
]
LTD_CATEGORICAL = [
    "Insured Salary Ind", "Claim Cause Desc", "Claim State", "Coverage Code",
    "DOT Exertion Level (Primary)", "Eligibility Outcome", "Insured Gender",
    "Insured State", "Mental Nervous Ind", "Pre-Ex Outcome", "Occ Category",
    "Primary Diagnosis Category", "Primary Diagnosis Code",
    "Primary Diagnosis Desc", "SIC Category", "SS Adjustment Ind",
    "SS Eligible Ind", "SS Pursue Ind", "SS Reject Code",
    "Voc Rehab Active Status", "Voc Rehab Outcome",
]
LTD_REQUIRED = [
    "Insured Age at Loss", "Insured Annualized Salary", "Policy Lives",
    "days_to_report", "emp_tenure", "prognosis_days", "Insured Gender",
    "Insured Salary Ind", "Primary Diagnosis Category", "Coverage Code",
    "last_first_payment_lag",
]
LTD_SALARY_FREQUENCY = {
    "A": "YEARLY", "M": "MONTHLY", "W": "WEEKLY", "B": "BI-WEEKLY", "H": "HOURLY",
}
LTD_PRE_EXISTING = {"YES": "Y", "NO": "N"}

# --- Settlement ------------------------------------------------------------

SETTLEMENT_PRIOR_ORIGINAL = 0.1
SETTLEMENT_PRIOR_TRAIN = 0.5
SETTLEMENT_WEIGHTS = [0.3, 0.7]

SETTLEMENT_DATES = [
    "Received Date", "Loss Date", "Insured Hire Date", "Duration Date",
    "Policy Effective Date", "Policy Termination Date", "First Payment From Date",
]
SETTLEMENT_NUMERIC = [
    "Insured Age at Loss", "Insured Annualized Salary", "Duration Months",
    "Policy Lives",
]
SETTLEMENT_CATEGORICAL = [
    "Insured Gender", "TSA Ind", "SS Pri Status", "SS Adjustment Ind",
    "Pre-Ex Outcome", "Insured Salary Ind", "Primary Diagnosis Category",
    "DOT Exertion Level (Primary)", "SS Pri Award Amt", "Coverage Code",
    "SIC Code",
]
SETTLEMENT_COLUMNS = (
    ["Claim Identifier"]
    + SETTLEMENT_DATES
    + SETTLEMENT_NUMERIC
    + SETTLEMENT_CATEGORICAL
    + ["Primary Diagnosis Code", "Primary Diagnosis Desc"]
)
SETTLEMENT_REQUIRED = [
    "Insured Gender", "TSA Ind", "SS Pri Status", "SS Adjustment Ind",
    "Pre-Ex Outcome", "SS Pri Award Amt", "Primary Diagnosis Category",
    "Coverage Code", "SIC Code", "Primary Diagnosis Code",
    "Insured Age at Loss", "Insured Annualized Salary", "Policy Lives",
    "policy_tenure", "days_to_report", "prognosis_days",
    "Primary Diagnosis Desc",
]
SETTLEMENT_SCALED = [
    "policy_tenure", "days_to_report", "emp_tenure", "prognosis_days",
    "days_to_first_payment", "Insured Annualized Salary",
    "Insured Age at Loss", "Policy Lives",
]
SETTLEMENT_ONE_HOT = [
    "Insured Gender", "TSA Ind", "SS Pri Status", "SS Adjustment Ind",
    "Pre-Ex Outcome", "SS Pri Award Amt", "Primary Diagnosis Category",
    "Coverage Code", "SIC Category", "pd_1_cat", "pd_2_cat",
]
# The musculoskeletal and respiratory results are exchanged in the published
# values; trained weights depend on it, so the exchange is kept.
SETTLEMENT_DIAGNOSIS_PREFIXES = [
    ("diseases of the circulatory system", "disease_circulatory_system"),
    ("diseases of the eye & adnexa", "disease_eye_adnexa"),
    ("diseases of the ear & mastoid process", "disease_ear_mastoid"),
    ("diseases of the musculoskeletal system & connectiv", "disease_respiratory_system"),
    ("diseases of the respiratory system", "disease_musculoskeletal"),
    ("injury, poisoning & certain other consequences of", "injury_poisonining"),
    ("mental, behavioral & neurodevelopmental disorders", "disease_mental_neuro"),
    ("neoplasms", "neoplasms"),
]
SETTLEMENT_DIAGNOSIS_GROUPS = [
    "disease_eye_adnexa", "disease_circulatory_system", "disease_ear_mastoid",
    "disease_respiratory_system", "disease_musculoskeletal",
    "injury_poisonining", "disease_mental_neuro", "neoplasms",
]
SETTLEMENT_SIC_KEPT = [
    "59", "26", "15", "32", "64", "44", "30", "56", "67", "49", "92", "73",
    "79", "63", "27", "99", "51", "34", "82", "80",
]
SETTLEMENT_SALARY_DROPPED = ["BI-WEEKLY", "Unknown", "WEEKLY", "YEARLY"]
SETTLEMENT_SS_STATUS_DROPPED = [
    "Appealed", "Appealed ALJ", "Not Applied", "Pending", "Unknown",
]
SETTLEMENT_COVERAGE_MERGED = ["LTDBU", "LTDCORE", "LTDVOL"]
SETTLEMENT_CODE1_TIERS = {
    "very_high": [
        "H35", "N30", "R29", "S13", "S33", "M96", "G60", "I73", "K50", "S92",
        "M06", "M41", "M50", "M60", "M46", "G82", "G83", "H81", "H90", "I89",
        "M24", "M72", "R53", "S12", "S52", "S89",
    ],
    "high": [
        "G90", "I67", "M15", "M47", "M51", "M54", "S93", "B20", "G56", "G81",
        "G89", "H47", "I47", "M62", "M87", "R00", "S14", "S73",
    ],
    "medium": [
        "G43", "M48", "S82", "G61", "J45", "S32", "Z51", "G71", "G93", "H33",
        "L40", "M35", "M43", "E11", "F07", "G44", "G95", "G40", "C54", "C92",
    ],
}
SETTLEMENT_CODE2_TIERS = {
    "very_high": [
        "5XXA", "009", "030A", "14", "201A", "47", "898", "90XA", "019", "36",
        "009A", "06",
    ],
    "high": [
        "34", "100", "001", "059", "119", "239", "39", "51", "909", "92XA",
        "09", "409A", "80", "109A", "30", "82", "5", "111", "13", "311",
        "354", "52", "659", "812",
    ],
    "medium": [
        "20", "26", "061", "109", "609", "817", "89", "12", "50", "219A",
        "529", "901", "9XXA", "00", "04", "02", "4",
    ],
}
SETTLEMENT_AWARD_BINS = {
    "(0-1000)": ["(0-250)", "(250-500)", "(500-750)", "(750-1000)"],
    "(1000-1250)": ["(1000-1250)"],
    "(1250-1500)": ["(1250-1500)"],
    "(1500-1750)": ["(1500-1750)"],
    "(1750-3000)": [
        "(1750-2000)", "(2000-2250)", "(2250-2500)", "(2500-2750)",
        "(2750-3000)",
    ],
    "others": ["(3000-3250)", "NA"],
}
# flag name -> substrings, any of which sets the flag
SETTLEMENT_KEYWORDS = {
    "medical_cond_comb_intervertebral disease": ["intervertebral dis"],
    "medical_cond_comb_cerebrovascular disease": ["cerebrovascular"],
    "medical_cond_comb_fracture": ["fracture"],
    "medical_cond_comb_acetabulum disorder": ["acetabulum"],
    "medical_cond_comb_spondylosis": ["spondylo"],
    "medical_cond_comb_sprain": ["sprain"],
    "medical_cond_comb_localization related": ["localization"],
    "medical_cond_comb_pain": ["pain"],
    "sys_organ_comb_cervical": ["cervi"],
    "sys_organ_comb_ligament": ["ligament"],
    "sys_organ_comb_lumbosacral": ["lumbosacral"],
    "sys_organ_comb_ankle": ["ankle"],
    "sys_organ_comb_thoracic region": ["thorac", "thorax"],
}
SETTLEMENT_CONDITIONS = [
    "hematuria", "dorsalgia", "tibial tendinitis", "idiopathic scoliosis",
    "laceration", "bucket-handle tear", "myositis", "concussion",
    "inflammatory demyelinating polyneuritis", "peripheral vascular disease",
    "migraine", "dislocation", "postlaminectomy syndrome", "back pain",
    "hemiplegia", "cervical disc displacement", "rheumatoid arthritis",
    "type 2 diabetes mellitus", "cervical disc disorders",
    "calcific tendinitis", "vascular headache", "crohn's disease",
    "guillain-barre syndrome", "carpal tunnel syndrome",
    "ischemic optic neuropathy", "cervical disc disorder", "lymphedema",
    "meniere's disease", "malignant neoplasm of endometrium",
    "myeloblastic leukemia", "postconcussional syndrome", "paraplegia",
    "asthma", "pigmentary retinal dystrophy", "human immunodeficiency virus",
    "polyosteoarthritis", "proliferative diabet", "syringomyelia", "sciatica",
    "tachycardia", "spinal stenosis", "radiculopathy",
    "cervical disc degeneration", "epilepsy", "arthritis",
    "muscular dystrophy", "rupture",
]
SETTLEMENT_ORGANS = [
    "acetabulum", "back", "ear", "intervertebral disc", "eye", "bilateral",
    "ulnar nerve", "upper", "wrist", "joint", "leg", "limb", "hip",
    "endometrium", "spinal cord", "lumbar region", "rotator cuff",
    "calcaneus", "pelvis", "shaft of right tibia", "spleen", "peripheral",
    "shoulder",
]
CONDITION_PREFIX = "medical_cond_comb_"
ORGAN_PREFIX = "sys_organ_comb_"

# --- Bridging from short-term to long-term ---------------------------------

BRIDGING_COLUMNS = [
    "ClaimNumber", "PrimaryDiagnosisCode", "SICCode", "InsuredGender",
    "InsuredSalaryIndicator", "DOTPrimaryExertionLevel", "CaseSize",
    "PrimaryDiagnosisDecription", "PrimaryDiagnosisCategory",
    "InsuredAgeatLoss", "InsuredAnnualizedSalary", "InsuredHireDate",
    "ReceivedDate", "LossDate",
]
BRIDGING_CATEGORICAL = [
    "pd_code_1", "pd_code_2", "SIC_category", "InsuredGender",
    "InsuredSalaryIndicator", "DOTPrimaryExertionLevel", "CaseSize",
    "PrimaryDiagnosisCategory",
]
BRIDGING_ELIGIBLE = ["Benefit Case Under Review"]
BRIDGING_REVIEW_STATUS = "Benefit Case Under Review"
BRIDGING_CLOSED_CODE = "Closed"
BRIDGING_BENEFIT_TYPE = "STD"
OUT_OF_VOCABULARY = "OOV"

# --- Annuity applications and transactions ---------------------------------

APPLICATION_THRESHOLD = 0.5056200992793571
TRANSACTION_THRESHOLD = 0.3193858391936
BATCH_ENTITY = "RAND1209"
BATCH_SOURCE = "RANDN1209:0"

WEB_LOGIN = "WebServices"
# position in the list + 1 is the number in the feature name emp_level_<n>
APPLICATION_LOGINS = [
    "160frx", "160mrx", "162blx", "470FJX", "470bmx", "470bpx", "470ckx",
    "470ddx", "470djl", "470fnx", "470fsx", "470grw", "470kax", "470kse",
    "470lcr", "470lgk", "470max", "470sce", "470tas", "470vrd", "470wbm",
    "725ccy",
]
TRANSACTION_LOGINS = [
    "470kjr", "470mkx", "470mex", "470whx", "470jax", "470srl", "725dpl",
    "470gtc", "303dwk", "470qda", "470hcl", "163fax", "470fbd", "470bpx",
    "470tbf", "725rtr", "205tdx", "302wrw", "110btw", "470knx",
]
# emp_level_2 is computed for transactions but is not one of their features
TRANSACTION_UNUSED_LEVELS = ["emp_level_2"]

APPLICATION_NUMERIC = [
    "FINANCIALGOALSDATA_SUITABILITYSCORE", "uc2_employee_flag",
    "uc2_employee_total_policy_count", "uc2_employee_policy_value",
    "uc7_employee_ratio", "uc8_employee_flag", "POLICYCOVHDRDATA_ISSUEAGE",
    "NBPAYMENTSDATA_FORMATAMOUNT", "NBAGENTDATA_PERCENTAGE",
    "NBANNUITYDATA_CHARGESINCURREPLACE", "NBANNUITYDATA_CASHWITHAPP",
    "NBPAYMENTSDATA_COMMISSIONRETAINED",
    "NBREPLACEMENTINFODATA_ESTIMATEDVALUE", "NBANNUITYDATA_EXPECTEDPREM",
    "TRXHDRDATA_PROCESSEDDATEdiff", "POLICYCOVHDRDATA_ISSUEDATEdiff",
    "NBANNUITYDATA_APPSIGNDATEdiff",
    "NBREPLACEMENTINFODATA_PAPERWORKRECEIVEDDATEdiff",
    "APPBENEFITDATA_STARTDATEdiff", "CASEHDRDATA_DATEISSUEDdiff",
    "CASEHDRDATA_DATERECEIVEDdiff", "CASEHDRDATA_EAPPDATARECEIVEDdiff",
    "CASEHDRDATA_TIMESTAMPdiff", "FINANCIALGOALSDATA_TIMESTAMPdiff",
    "no_employees", "NBANNUITYDATA_ANNUITYPOLICYOPTION_SPDA", "webservices",
]
# numeric features that are not quantile-transformed
APPLICATION_NOT_TRANSFORMED = [
    "uc2_employee_flag", "uc8_employee_flag", "no_employees", "webservices",
]
APPLICATION_CATEGORICAL = [
    "NBANNUITYDATA_APPSIGNSTATE_VALUE", "POLICYHDRDATA_PRODMODELID_VALUE",
    "NBANNUITYDATA_APPSTATUS_VALUE", "NBANNUITYDATA_APPSOURCE_VALUE",
    "APPCOVERAGESDATA_PRODMODELID_VALUE",
    "NBANNUITYDATA_OWNERPARTYTYPE_VALUE",
    "NBANNUITYDATA_ESIGNATUREIND_VALUE",
    "NBANNUITYDATA_OWNERANNUITANTFLAG_VALUE",
    "NBANNUITYDATA_ISREPLACEMENT_VALUE", "NBANNUITYDATA_ISGROUP_VALUE",
    "NBPAYMENTSDATA_PREMIUMTYPE_CODE", "NBANNUITYDATA_ANNUITYPOLICYOPTION",
    "NBANNUITYDATA_COMMOPTIONTYPE_VALUE", "NBANNUITYDATA_ANNUITYPOLICYTYPE",
    "NBANNUITYDATA_ADEQUATEASSETS_VALUE",
    "NBANNUITYDATA_PURPOSEOFACCOUNT_VALUE", "NBPAYMENTSDATA_METHOD",
    "NBANNUITYDATA_SYSTEMATICWITHDRAWAL_VALUE",
    "NBANNUITYDATA_CHECKFORMS_VALUE", "NBANNUITYDATA_ROLLOVER_VALUE",
    "NBANNUITYDATA_QUALIFIED_VALUE", "NBAGENTDATA_ISPRIMARY_VALUE",
    "CASEHDRDATA_ISGROUP_VALUE", "CASEHDRDATA_STATUS_VALUE",
    "CASEHDRDATA_UNDERWRITINGSTATUS_VALUE",
    "FINANCIALGOALSDATA_EXPECTEDSURRPENALTY_CODE",
    "FINANCIALGOALSDATA_REVERSEMORTGAGE_CODE",
    "CASEHDRDATA_ESIGNATUREIND_VALUE",
    "FINANCIALGOALSDATA_ADEQUATEASSETS_VALUE",
]
APPLICATION_DEFAULTS = {
    "uc2_employee_ratio": -1.0,
    "uc7_employee_ratio": -1.0,
    "uc8_employee_mean_change_days": -1.0,
    "uc8_employee_ratio": -1.0,
    "NBPAYMENTSDATA_PREMIUMTYPE_CODE": "UNK",
    "NBANNUITYDATA_PURPOSEOFACCOUNT_VALUE": "UNK",
    "NBPAYMENTSDATA_METHOD": "UNK",
    "NBAGENTDATA_ISPRIMARY_VALUE": "Blank",
    "FINANCIALGOALSDATA_EXPECTEDSURRPENALTY_CODE": "Blank",
    "FINANCIALGOALSDATA_REVERSEMORTGAGE_CODE": "Blank",
}
TRANSACTION_CATEGORICAL = [
    "CONTRACTDATA_WRITINGCODE", "TRXHDRDATA_TRXTYPEID_VALUE",
    "POLICYHDRDATA_PRODMODELID_VALUE", "EVENT", "POLICYHDRDATA_PLANOPTION",
    "POLICYHDRDATA_QUALIFIEDCODE_VALUE", "POLICYCOVHDRDATA_COVOPTION",
    "POLICYCOVHDRDATA_STATUS_VALUE", "NBANNUITYDATA_OWNERPARTYTYPE_VALUE",
    "TXN_TYPE",
]
TRANSACTION_NUMERIC = [
    "uc2_employee_flag", "uc2_employee_total_policy_count",
    "uc7_employee_flag", "uc7_employee_zero_task_count",
    "uc7_employee_ratio", "uc8_employee_flag", "uc8_employee_policy_count",
    "uc8_employee_mean_change_days", "uc8_employee_ratio",
    "POLICYCOVHDRDATA_ISSUEAGE", "TRXRESDATA_FORMATACCTVALUE",
    "TRXRESDADATA_YTDWITHDRAWALS", "TRXRESDADATA_YTDSURRENDERCHARGE",
    "TRXRESDATA_AMTPROCESSED", "POLICYHDRDATA_FREELOOKPERIOD",
    "POLICYCOVHDRDATA_RETIREMENTAGE", "POLICYCOVHDRDATA_ISSUEDATEdiff",
    "POLICYHDRDATA_TIMESTAMPdiff", "CLAIMHDRDATA_DATEOFLOSSdiff",
    "CLAIMHDRDATA_DATEREPORTEDdiff", "CLAIMHDRDATA_TIMESTAMPdiff",
    "POLICYCOVHDRDATA_ENDDATEdiff", "POLICYCOVHDRDATA_TERMINATIONDATEdiff",
    "POLICYFUNDALLOCDATA_TIMESTAMPdiff", "NBANNUITYDATA_APPDATEISSUEDdiff",
    "CASEHDRDATA_EAPPDATARECEIVEDdiff", "POLICYCOVHDRDATA_duration",
    "no_employees", "predicted_disposition_inconsistent",
    "TXN_TYPE_non-financial-transaction", "webservices",
]
TRANSACTION_BOOLEAN = [
    "POLICYHDRDATA_ISGROUP_VALUE", "POLICYHDRDATA_QUALIFIED_VALUE",
    "POLICYHDRDATA_REPLACEMENTFLAG_VALUE",
    "POLICYCOVHDRDATA_ISPARTOFCLAIM_VALUE",
]
TRANSACTION_DEFAULTS = {
    "NBANNUITYDATA_OWNERPARTYTYPE_VALUE": "Unknown",
    "uc8_employee_mean_change_days": -1.0,
    "CONTRACTDATA_WRITINGCODE": "['Unknown']",
    "uc7_employee_ratio": -1.0,
    "uc8_employee_ratio": -1.0,
}

# --- Column-header labelling -----------------------------------------------

HEADER_SEQUENCE_LENGTH = 16
UNKNOWN_LABEL = "UNK"
# class index is the position in the list
PRODUCT_LABELS = [
    "ACC", "ADD", "ADD LIFE", "ADDSUP", "ADDVOL", "ASOFEE", "CHADD", "CHCRIT",
    "CHLIFE", "CIW", "COBRA", "COBRADEN", "COBRAVIS", "CRIT", "DEN",
    "DEPLIFE", "EAPFEE", "FMLA", "HEALTH", "LIFE", "LIFESUP", "LIFEVOL",
    "LTD", "LTDVOL", "SPADD", "SPCRIT", "SPLIFE", "STADD", "STD", "STDVOL",
    "UNK", "VIS",
]
HEADER_LABELS = [
    "AccountNumber", "Action", "Address", "AddressLine1", "AddressLine2",
    "AddressLine3", "AdjustDeductAmt", "Age", "AgeGroup",
    "Alt_IdentityNumber", "Applied For Amount", "BeneficiaryType",
    "BenefitAmount", "BenefitClass", "BenefitPercentage", "BillingDivision",
    "BinaryResponse", "COVERAGE AMOUNT", "COVERAGEAMOUNT", "Carrier", "City",
    "Country", "CoverageAmount", "CoverageTier", "Covered Payroll",
    "CurrencySalary", "DateOfBirth", "DisabilityInd", "DriversLicense",
    "EOI_Amount", "EffectiveDate", "EligGroup", "EligibilityInd",
    "EmploymentStatus", "FLSAStatus", "FSAamount", "FirstName", "FullName",
    "GF_BenefitAmount", "GF_Indicator", "GI_Amount", "Gender", "GenericDate",
    "GenericInd", "Generic_ID", "Grandfathered Amount", "GroupNumber",
    "GuaranteeIssueInd", "HireDate", "IDType", "IdentityNumber",
    "Inforce Amount", "InforceAmount", "InforceInd", "JobTitle", "LastName",
    "Location", "MaritalStatus", "MemberID", "MiddleInitial", "MiddleName",
    "NotesOrDesc", "NumDependents", "NumWorkingHoursWeek", "PhoneNumber",
    "PlanCode", "Premium", "PremiumFreq", "Product", "ProductPlanNameOrCode",
    "Provider", "Reason", "RehireDate", "Relationship", "SSN", "Salary",
    "SalaryEffectiveDate", "SalaryFreq", "SecondaryAccountNumber",
    "SeqNumber", "State", "TERMINATIONDATE", "TaxStatus", "TerminationDate",
    "TerminationReasonCode", "TimeFreq", "TobaccoUserOrSmokerInd", "UNK",
    "USCounty", "Units", "WaiveReason", "WorkLocation", "Zip",
    "effectivedate", "emailAddress", "terminationdate",
]
PARTY_LABELS = [
    "Beneficiary-1", "Beneficiary-2", "Beneficiary-3", "Beneficiary-4",
    "Beneficiary-5", "CB-1", "CB-2", "CB-3", "CB-4", "CB-5", "Child",
    "Child-1", "Child-2", "Child-3", "Child-4", "Child-5", "Child-6",
    "Child-7", "Dependent", "Dependent-1", "Dependent-2", "Dependent-3",
    "Dependent-4", "Dependent-5", "Dependent-6", "Employer", "Primary",
    "Spouse", "UNK",
]
PERSONAL_HEADERS = [
    "DateOfBirth", "FirstName", "Gender", "LastName", "Address",
    "AddressLine2", "City", "State", "AddressLine1", "Zip", "Relationship",
]
VOLUNTARY_LIFE_AMOUNTS = [
    "Supplemental/Voluntary_Employee_Life_In_Force_Amount",
    "Supplemental/Voluntary_Employee_Life_Applied_For_Amount",
]
VOLUNTARY_ADD_AMOUNTS = [
    "Supplemental/Voluntary_Employee_AD&D_Applied_For_Amount",
    "Supplemental/Voluntary_Employee_AD&D_In_Force_Amount",
]
SUPPLEMENTAL_LIFE_BENEFITS = [
    "EMPLOYEE_Voluntary/Supplemental_Coverage_LIFE_Benefit_Amount",
    "EMPLOYEE_Voluntary/SupplementalCoverage_LIFE_Benefit_Amount",
]
BASIC_LIFE_AMOUNTS = ["Basic_Life_In_Force_Amount", "Basic_Life_Applied_For_Amount"]

# --- Entities in diagnosis texts -------------------------------------------

# label of a match -> output list; labels that are not listed are dropped
ENTITY_LISTS = {
    "SYSTEM_ORGAN_SITE": "system_organ_site",
    "DX_NAME": "diagnosis_name",
    "DIRECTION": "direction",
    "ACUITY": "acuity",
    "PROCEDURE_NAME": "procedure",
    "TEST_NAME": "test",
    "GENERIC_NAME": "generic_name",
    "NAME": "name",
}
