"""Lookup values that define the business vocabulary of the star.

FIXED VALUES: the entries below must stay exactly as written (spelling, case and
order) for the conformed dimensions to come out right.  Order matters where a
position is used (drug-name lists are indexed by key modulo length; customer
types by first substring match).
"""

# ---------------------------------------------------------------- FIXED VALUES
# product category -> (therapeutic class, class code, ATC group)
CATEGORY_TO_CLASS = {
    "Bikes": ("Cardiovascular Drugs", "C01", "ATC-C"),
    "Components": ("Antibiotics", "J01", "ATC-J"),
    "Clothing": ("Dermatological Agents", "D01", "ATC-D"),
    "Accessories": ("Analgesics", "N02", "ATC-N"),
}
DEFAULT_CLASS = ("Pharmaceutical", "Z00", "ATC-Z")

# product subcategory -> therapeutic subclass (default: the subcategory name itself)
SUBCATEGORY_TO_SUBCLASS = {
    "Mountain Bikes": "Beta Blockers",
    "Road Bikes": "ACE Inhibitors",
    "Touring Bikes": "Calcium Channel Blockers",
    "Handlebars": "Penicillins",
    "Bottom Brackets": "Cephalosporins",
    "Brakes": "Macrolides",
    "Jerseys": "Topical Steroids",
    "Shorts": "Antifungals",
    "Vests": "Emollients",
    "Helmets": "NSAIDs",
    "Hydration Packs": "Opioids",
    "Tires and Tubes": "Quinolones",
    "Pedals": "Tetracyclines",
    "Saddles": "Aminoglycosides",
    "Wheels": "Carbapenems",
    "Gloves": "Antivirals",
    "Socks": "Antifungal Topical",
    "Caps": "Antiparasitic",
    "Fenders": "Analgesic Topical",
    "Locks": "Muscle Relaxants",
    "Panniers": "Antihistamines",
    "Pumps": "Antacids",
    "Lights": "Decongestants",
}

# therapeutic class -> regulatory schedule (default "Schedule H")
CLASS_TO_REGULATORY = {
    "Cardiovascular Drugs": "Schedule H",
    "Antibiotics": "Schedule H1",
    "Dermatological Agents": "Schedule G",
    "Analgesics": "Schedule H",
}
DEFAULT_REGULATORY = "Schedule H"

# subcategory -> generic drug names; "General" is the fallback list
DRUG_NAMES = {
    "Mountain Bikes": ["Ramipril", "Lisinopril", "Enalapril", "Captopril", "Perindopril",
                       "Trandolapril", "Quinapril", "Fosinopril", "Benazepril", "Moexipril"],
    "Road Bikes": ["Metoprolol", "Atenolol", "Bisoprolol", "Carvedilol", "Propranolol",
                   "Nebivolol", "Acebutolol", "Betaxolol", "Labetalol", "Nadolol"],
    "Touring Bikes": ["Amlodipine", "Nifedipine", "Diltiazem", "Verapamil", "Felodipine",
                      "Isradipine", "Nimodipine", "Nisoldipine", "Clevidipine", "Lercanidipine"],
    "Handlebars": ["Amoxicillin", "Ampicillin", "Cloxacillin", "Flucloxacillin", "Dicloxacillin",
                   "Nafcillin", "Oxacillin", "Piperacillin", "Ticarcillin", "Carbenicillin"],
    "Bottom Brackets": ["Azithromycin", "Erythromycin", "Clarithromycin", "Roxithromycin", "Telithromycin",
                        "Spiramycin", "Josamycin", "Midecamycin", "Troleandomycin", "Fidaxomicin"],
    "Brakes": ["Ciprofloxacin", "Levofloxacin", "Ofloxacin", "Norfloxacin", "Moxifloxacin",
               "Gatifloxacin", "Sparfloxacin", "Enoxacin", "Pefloxacin", "Fleroxacin"],
    "Jerseys": ["Betamethasone", "Clobetasol", "Hydrocortisone", "Mometasone", "Triamcinolone",
                "Fluticasone", "Prednisolone", "Dexamethasone", "Budesonide", "Beclomethasone"],
    "Shorts": ["Clotrimazole", "Fluconazole", "Miconazole", "Ketoconazole", "Itraconazole",
               "Voriconazole", "Posaconazole", "Terbinafine", "Griseofulvin", "Nystatin"],
    "Vests": ["Emollient Cream", "Aqueous Cream", "Paraffin Cream", "Urea Cream", "Calamine Cream",
              "Zinc Cream", "Lanolin Cream", "Cetomacrogol Cream", "Oat Cream", "Aloe Vera Cream"],
    "Helmets": ["Ibuprofen", "Naproxen", "Diclofenac", "Aspirin", "Celecoxib",
                "Etoricoxib", "Indomethacin", "Meloxicam", "Piroxicam", "Ketoprofen"],
    "Hydration Packs": ["Tramadol", "Codeine", "Morphine", "Oxycodone", "Fentanyl",
                        "Buprenorphine", "Hydrocodone", "Tapentadol", "Methadone", "Pethidine"],
    "Tires and Tubes": ["Tetracycline", "Doxycycline", "Minocycline", "Oxytetracycline", "Chlortetracycline",
                        "Demeclocycline", "Meclocycline", "Methacycline", "Rolitetracycline", "Lymecycline"],
    "Pedals": ["Gentamicin", "Streptomycin", "Neomycin", "Tobramycin", "Amikacin",
               "Kanamycin", "Netilmicin", "Sisomicin", "Isepamicin", "Plazomicin"],
    "Saddles": ["Losartan", "Valsartan", "Irbesartan", "Candesartan", "Olmesartan",
                "Telmisartan", "Azilsartan", "Eprosartan", "Fimasartan", "Saprisartan"],
    "Wheels": ["Meropenem", "Imipenem", "Ertapenem", "Doripenem", "Biapenem",
               "Faropenem", "Panipenem", "Razupenem", "Tebipenem", "Sulopenem"],
    "Gloves": ["Acyclovir", "Valacyclovir", "Famciclovir", "Ganciclovir", "Valganciclovir",
               "Cidofovir", "Foscarnet", "Penciclovir", "Docosanol", "Idoxuridine"],
    "Socks": ["Terbinafine", "Griseofulvin", "Itraconazole", "Voriconazole", "Posaconazole",
              "Amorolfine", "Ciclopirox", "Butenafine", "Naftifine", "Tolnaftate"],
    "Caps": ["Mebendazole", "Albendazole", "Ivermectin", "Praziquantel", "Pyrantel",
             "Levamisole", "Niclosamide", "Diethylcarbamazine", "Triclabendazole", "Oxamniquine"],
    "Fenders": ["Diclofenac Gel", "Ibuprofen Gel", "Piroxicam Gel", "Ketoprofen Gel", "Indomethacin Gel",
                "Nimesulide Gel", "Naproxen Gel", "Flurbiprofen Gel", "Aceclofenac Gel", "Lornoxicam Gel"],
    "Locks": ["Baclofen", "Tizanidine", "Cyclobenzaprine", "Methocarbamol", "Carisoprodol",
              "Chlorzoxazone", "Orphenadrine", "Dantrolene", "Quinine", "Tolperisone"],
    "Panniers": ["Cetirizine", "Loratadine", "Fexofenadine", "Desloratadine", "Levocetirizine",
                 "Bilastine", "Rupatadine", "Ebastine", "Azelastine", "Mizolastine"],
    "Pumps": ["Omeprazole", "Pantoprazole", "Esomeprazole", "Lansoprazole", "Rabeprazole",
              "Dexlansoprazole", "Ilaprazole", "Tenatoprazole", "Vonoprazan", "Revaprazan"],
    "Lights": ["Pseudoephedrine", "Phenylephrine", "Oxymetazoline", "Xylometazoline", "Naphazoline",
               "Tramazoline", "Tuaminoheptane", "Synephrine", "Octodrine", "Propylhexedrine"],
    "General": ["Paracetamol", "Chlorpheniramine", "Dextromethorphan", "Guaifenesin", "Phenylephrine",
                "Caffeine", "Vitamin C", "Zinc Sulphate", "Magnesium", "Calcium Carbonate"],
}
FALLBACK_NAME_LIST = "General"

# product colour -> dosage form (default "Tablet")
COLOR_TO_FORM = {
    "Blue": "Capsule",
    "Red": "Tablet",
    "Black": "Injection",
    "White": "Syrup",
    "Yellow": "Cream",
    "Silver": "Ointment",
    "Grey": "Gel",
    "Multi": "Suspension",
}
DEFAULT_FORM = "Tablet"

# product size -> dosage strength (default "250mg")
SIZE_TO_STRENGTH = {
    "S": "100mg",
    "M": "250mg",
    "L": "500mg",
    "XL": "1000mg",
    "38": "200mg",
    "40": "400mg",
    "42": "600mg",
    "44": "800mg",
    "48": "1200mg",
    "52": "1500mg",
    "56": "2000mg",
    "58": "50mg",
    "60": "150mg",
    "62": "300mg",
}
DEFAULT_STRENGTH = "250mg"

# suffix codes used when a drug name is already taken, indexed by key mod 10
NAME_SUFFIX_CODES = ["XR", "SR", "LA", "CR", "ER", "IR", "MR", "DR", "PR", "EC"]

# customer key range (inclusive) -> (customer type, segment); first match wins
CUSTOMER_KEY_RANGES = [
    (1, 5000, "Hospital", "Government"),
    (5001, 10000, "Pharmacy", "Retail"),
    (10001, 15000, "Clinic", "Private"),
    (15001, 20000, "Wholesale Distributor", "Wholesale"),
    (20001, 99999, "Retail Chain", "Retail"),
]
DEFAULT_CUSTOMER_TYPE = ("Hospital", "Government")

# customer type -> name suffix used to build the customer name
CUSTOMER_NAME_SUFFIX = {
    "Hospital": "General Hospital",
    "Clinic": "Multispeciality Clinic",
    "Pharmacy": "Pharmacy",
    "Wholesale Distributor": "Medical Wholesale",
}
DEFAULT_CUSTOMER_NAME_SUFFIX = "Retail Chain"

# country (exact, case-sensitive) -> distribution zone (default "International Zone")
COUNTRY_TO_ZONE = {
    "United States": "North America Zone",
    "Canada": "North America Zone",
    "France": "Europe Zone",
    "Germany": "Europe Zone",
    "United Kingdom": "Europe Zone",
    "Australia": "Asia-Pacific Zone",
    "India": "Asia Zone",
}
DEFAULT_ZONE = "International Zone"

# upload customer-type keywords, tested in this order by substring (default "Hospital")
UPLOAD_CUSTOMER_TYPES = [
    ("hospital", "Hospital"),
    ("clinic", "Clinic"),
    ("pharmacy", "Pharmacy"),
    ("wholesale", "Wholesale Distributor"),
    ("distributor", "Wholesale Distributor"),
    ("retail", "Retail Chain"),
    ("government", "Government"),
]
DEFAULT_UPLOAD_CUSTOMER_TYPE = "Hospital"

# stock status bands over units on hand
STOCK_OUT, STOCK_CRITICAL, STOCK_LOW, STOCK_OVER, STOCK_IN = (
    "Out of Stock", "Critical", "Low Stock", "Overstock", "In Stock")
CRITICAL_BELOW, LOW_BELOW, OVERSTOCK_ABOVE = 50, 150, 5000

# calendar names
MONTH_NAMES = ["January", "February", "March", "April", "May", "June",
               "July", "August", "September", "October", "November", "December"]
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# fixed texts of customer rows
CUSTOMER_CODE_FORMAT = "ZCU-%06d"
PAYMENT_TERMS = "Net30"
CUSTOMER_STATUS = "Active"
UPLOAD_CUSTOMER_SEGMENT = "Standard"

# upload file layouts
SALES_UPLOAD_COLUMNS = [
    "drug_name", "customer_name", "customer_type", "order_date",
    "units_sold", "unit_price", "unit_price_discount_pct",
    "total_product_cost", "sales_amount", "tax_amt", "freight",
    "sales_territory_name", "country_region", "city",
]
INVENTORY_UPLOAD_COLUMNS = [
    "drug_name", "snapshot_date", "units_on_hand",
    "units_ordered", "units_dispatched", "unit_cost",
]
# ------------------------------------------------------------ END FIXED VALUES
