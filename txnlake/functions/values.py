"""Taxonomy, rates, lookup tables and lists that results depend on."""

from __future__ import annotations

# Fixed values: (subcategory, category, classification), 82 rows.
MAPPING = [
    ("Internet", "Communication, PC", "NEED"),
    ("Phone, cell phone", "Communication, PC", "NEED"),
    ("Postal services", "Communication, PC", "NEED"),
    ("Software, apps, games", "Communication, PC", "WANT"),
    ("Advisory", "Financial expenses", "MUST"),
    ("Charges, Fees", "Financial expenses", "MUST"),
    ("Child Support", "Financial expenses", "MUST"),
    ("Fines", "Financial expenses", "MUST"),
    ("Insurances", "Financial expenses", "MUST"),
    ("Loan, interests", "Financial expenses", "MUST"),
    ("Taxes", "Financial expenses", "MUST"),
    ("Food & Drinks", "Food & Drinks", "NEED"),
    ("Groceries", "Food & Drinks", "NEED"),
    ("Bar, cafe", "Food & Drinks", "WANT"),
    ("Energy, utilities", "Housing", "MUST"),
    ("Maintenance, repairs", "Housing", "MUST"),
    ("Mortgage", "Housing", "MUST"),
    ("Property insurance", "Housing", "MUST"),
    ("Rent", "Housing", "MUST"),
    ("Services", "Housing", "MUST"),
    ("Aliments", "Income", None),
    ("Bonus, extra income", "Income", None),
    ("Checks, coupons", "Income", None),
    ("Dues & grants", "Income", None),
    ("Gifts", "Income", None),
    ("Interests, dividends", "Income", None),
    ("Investment income", "Income", None),
    ("Lending, renting", "Income", None),
    ("Other income", "Income", None),
    ("Refunds", "Income", None),
    ("Refunds (tax, purchase)", "Income", None),
    ("Rental income", "Income", None),
    ("Sale", "Income", None),
    ("Wage, invoices", "Income", None),
    ("Collections", "Investments", "WANT"),
    ("Cryptocurrency", "Investments", "WANT"),
    ("Financial investments", "Investments", "WANT"),
    ("Investments", "Investments", "WANT"),
    ("Realty", "Investments", "WANT"),
    ("Savings", "Investments", "WANT"),
    ("Stocks, bonds", "Investments", "WANT"),
    ("Vehicles, chattels", "Investments", "WANT"),
    ("Active sport, fitness", "Life & Entertainment", "WANT"),
    ("Alcohol, tobacco", "Life & Entertainment", "WANT"),
    ("Books, audio, subscriptions", "Life & Entertainment", "WANT"),
    ("Charity, gifts", "Life & Entertainment", "WANT"),
    ("Culture, sport events", "Life & Entertainment", "WANT"),
    ("Education, development", "Life & Entertainment", "WANT"),
    ("Health care, doctor", "Life & Entertainment", "WANT"),
    ("Hobbies", "Life & Entertainment", "WANT"),
    ("Holiday, trips, hotels", "Life & Entertainment", "WANT"),
    ("Life events", "Life & Entertainment", "WANT"),
    ("Lottery, gambling", "Life & Entertainment", "WANT"),
    ("TV, Streaming", "Life & Entertainment", "WANT"),
    ("Wellness, beauty", "Life & Entertainment", "WANT"),
    ("Other", "Other", "WANT"),
    ("Uncategorized", "Other", "WANT"),
    ("Unknown Expense", "Other", "WANT"),
    ("UNKNOWNN_CATEGORY", "Other", "WANT"),
    ("Clothes & shoes", "Shopping", "WANT"),
    ("Drug-store, chemist", "Shopping", "WANT"),
    ("Electronics, accessories", "Shopping", "WANT"),
    ("Free time", "Shopping", "WANT"),
    ("Gifts, joy", "Shopping", "WANT"),
    ("Health and beauty", "Shopping", "WANT"),
    ("Home, garden", "Shopping", "WANT"),
    ("Jewels, accessories", "Shopping", "WANT"),
    ("Kids", "Shopping", "WANT"),
    ("Pets, animals", "Shopping", "WANT"),
    ("Stationary, tools", "Shopping", "WANT"),
    ("Transfer", "Transfers", "WANT"),
    ("Transfer, withdraw", "Transfers", "WANT"),
    ("Business trips", "Transportation", "NEED"),
    ("Long distance", "Transportation", "NEED"),
    ("Public transport", "Transportation", "NEED"),
    ("Taxi", "Transportation", "NEED"),
    ("Fuel", "Vehicle", "NEED"),
    ("Leasing", "Vehicle", "NEED"),
    ("Parking", "Vehicle", "NEED"),
    ("Rentals", "Vehicle", "NEED"),
    ("Vehicle insurance", "Vehicle", "NEED"),
    ("Vehicle maintenance", "Vehicle", "NEED"),
]

# EUR for one unit; unknown currencies count as EUR.
EUR_RATES = {"BGN": 0.51130, "EUR": 1.0, "USD": 1.17}
# Fixed values: (subcategory in the export, type) -> subcategory.
SUBCATEGORY_RENAMES = {("Aliments (Financial expenses)", "EXPENSE"): "Child Support", ("Aliments (Financial expenses)", "INCOME"): "Child Support"}
TYPES = {"expenses": "EXPENSE", "income": "INCOME"}
RECORD_TYPES = {"income": "Income", "expense": "Expenses", "expenses": "Expenses", "transfer": "Transfer"}
AVOIDABILITY = {"WANT": 1.0, "NEED": 0.4, "MUST": 0.05}
WEIGHTS = {"avoidability": 3.0, "frequency": 2.0, "amount": 1.0}
FREQUENCY_CAP, AMOUNT_CAP = 3.0, 5.0
SCALE = 0.73

# Date formats in the order in which they are tried.
DATE_FORMATS = [
    "yyyy-M-d", "yyyy-d-M", "M-d-yyyy", "d-M-yyyy", "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M/d/yyyy H:mm:ss", "d/M/yyyy H:mm:ss",
    "yyyy-M-d H:mm:ss", "yyyy-d-M H:mm:ss", "M-d-yyyy H:mm:ss", "d-M-yyyy H:mm:ss", "yyyy/M/d H:mm:ss", "M.d.yyyy", "d.M.yyyy",
    "yyyy.M.d", "yyyy.d.M", "yyyy M d", "yyyy d M", "yyyyMMdd", "MMMM d yyyy", "M/d/yy",
]
#: Written-out dates, tried after those.
FREE_DATES = [
    "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "MMM d yyyy", "d-MMM-yyyy", "d-MMM-yy", "d. MMMM yyyy", "yyyy MMM d",
    "yyyy-MMM-d", "MMMM yyyy", "MMM yyyy", "yyyy-M", "yyyy/M", "M/yyyy", "M/d/yyyy h:mm a", "M/d/yyyy h:mm:ss a", "yyyy-M-d H:mm", "M/d/yyyy H:mm",
    "d MMM yyyy H:mm:ss", "d MMM yyyy H:mm", "MMM d, yyyy h:mm:ss a", "MMM d, yyyy h:mm a", "yyyyMMddHHmmss",
]
# Pattern -> name of a date's format, in order.
DATE_SHAPES = [
    (r"^\d{4}-\d{2}-\d{2}$", "ISO 8601 (YYYY-MM-DD)"),
    (r"^\d{2}/\d{2}/\d{4}$", "US Format (MM/DD/YYYY)"),
    (r"^\d{2}\.\d{2}\.\d{4}$", "European Format (DD.MM.YYYY)"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "Flexible Format (M/D/YYYY)"),
    (r"^\d{4}/\d{2}/\d{2}$", "YYYY/MM/DD"),
    (r"^\d{2}-\d{2}-\d{4}$", "DD-MM-YYYY"),
    (r"^\d+$", "Unix Timestamp or Excel Serial"),
]
UNKNOWN_SHAPE = "Unknown / Custom Format"
ENCODINGS = ["utf-8", "utf-8-sig", "latin-1", "cp1252", "iso-8859-1"]

# Columns that a layer takes, in order.
STAGING_COLUMNS = ["date", "note", "type", "payee", "amount", "labels", "account", "category", "currency", "payment"]
BRONZE_COLUMNS = ["transaction_date", "description", "transaction_type", "payee", "amount", "labels", "account_name", "subcategory", "currency", "payment_method"]
SILVER_COLUMNS = [
    "transaction_hash", "transaction_date", "transaction_type", "amount", "amount_abs", "currency", "amount_eur", "amount_abs_eur",
    "eur_conversion_rate", "amount_bgn", "amount_abs_bgn", "source_record_id", "category_id", "description", "payee", "subcategory",
    "account_name", "payment_method", "labels", "year", "month", "quarter", "year_month", "day_of_week", "week_of_year", "is_weekend",
    "source_raw_id", "created_at", "created_by", "classification",
]

# Substring of the subcategory -> merchants, in the order in which they are tried.
MERCHANTS = {
    "barber": ["101 Barber Shop", "Men's Lounge", "Fade Brothers", "BarberStyle Sofia"],
    "fast food": ["McDonald's", "Speedy Burger", "French Tacos", "Rolling Dogs", "Mekitsa & Co", "Happy Pancakes", "Blue Taste Poké"],
    "deliver": ["Wolt", "Glovo", "foodpanda"],
    "coffee": ["Dabov Specialty Coffee", "Father Coffee Vinyls", "Blend Coffee Lab", "Single Origin Roasters", "Kaffeina", "Mocca House", "Black Sheep Coffee"],
    "bar, cafe": ["Club Dom", "Holy Smokes Bar", "Exe Club", "Absolut Bar", "Dabov Specialty Coffee", "Amora Coffee Shop", "Vinyl Underground"],
    "restaurant": ["Manastirska Magernitsa", "Mamma Mia Trattoria", "Gozba", "Batlars Bistro", "Osteria Tartufo", "La Bottega", "Happy Bar & Grill", "El Asador", "Vapiano", "Victoria Restaurant"],
    "food": ["Wolt", "Gozba", "Food Box", "Speedy Burger", "Manali"],
    "alcohol": ["Wine & More", "Alko DJ", "Metro Wines", "VinCo", "Premium Tabako"],
    "tobacco": ["Top Tobacco", "Premium Tabako", "Trishur Tobacco", "Tabachki"],
    "grocer": ["Lidl", "T-Market", "Kaufland", "Billa", "Fantastico", "CBA Market"],
    "online": ["Amazon", "Temu", "eMag", "Ozone.bg", "Remixshop"],
    "cloth": ["Reserved", "Zara", "H&M", "Pull&Bear", "Bershka", "Stradivarius", "Mango"],
    "electron": ["Technopolis", "Electro Camel", "Media Markt", "Samsung Store"],
    "home": ["IKEA", "Bauhaus", "Jysk", "Mr. Bricolage", "Praktiker"],
    "book": ["Helikon Bookstore", "Ciela", "Orange Bookstore", "Slaveykov Books", "Storytel"],
    "station": ["Bauhaus", "Mr. Bricolage", "Office 1", "Decathlon"],
    "culture": ["Eventim Bulgaria", "TicketStation", "National Palace of Culture", "Sofia Philharmonic", "Cinemax", "Cinema City"],
    "fitness": ["Vibes Fitness", "Mega Gym", "Sportal Center Europa", "Next Level Gym", "Genesis Fitness", "Pulse Fitness", "Smashers"],
    "beauty": ["Douglas", "Notino", "MAC Cosmetics", "Rituals", "Sephora"],
    "doctor": ["Aleksandrovska Hospital", "Tokuda Hospital", "City Clinic", "MedHelp"],
    "drug": ["Sopharmacy", "Profarma", "Benu Pharmacy", "Lily Drug Store", "Remedium", "Dr. Max"],
    "transport": ["CityGate Sofia Transit", "Metrostation Sofia", "Sofia Urban Mobility"],
    "taxi": ["Bolt", "Uber", "FreeNow"],
    "fuel": ["Lukoil", "Shell", "EKO", "OMV"],
    "tv, stream": ["Netflix", "HBO Max", "Disney+", "Apple TV+"],
    "software": ["Google One", "Microsoft 365", "Adobe Creative Cloud", "ChatGPT Plus", "Notion", "GitHub Pro", "Dropbox"],
    "internet": ["Vivacom", "A1 Bulgaria", "Yettel", "Bulsatcom"],
    "phone": ["A1 Bulgaria", "Yettel", "Vivacom"],
    "hotel": ["Marriott Sofia", "Hilton Sofia", "Radisson Blu", "Sense Hotel", "Park Inn by Radisson"],
    "flight": ["Ryanair", "Wizz Air", "Bulgaria Air", "easyJet"],
    "utilit": ["CEZ Group", "Sofiyska Voda", "Toplofikacia Sofia", "ePay"],
    "insur": ["Generali Insurance", "Allianz Bulgaria", "DZI", "Bulstrad"],
    "gaming": ["Blizzard Entertainment", "Steam", "PlayStation Store", "Epic Games"],
}
# Cities by kind of subcategory.
SUBSCRIPTION_CITIES = ["Dublin", "Dublin", "Luxembourg", "Stockholm", "Dublin"]
TRAVEL_CITIES = ["Amsterdam", "Prague", "Vienna", "Berlin", "Barcelona", "London", "Edinburgh", "Paris", "Rome", "Istanbul"]
TRAVEL_KEYS = ["hotel", "trip", "flight", "business trip"]
SUBSCRIPTION_KEYS = ["tv, stream", "software", "internet"]
OUTDOOR_KEYS = ["bar, cafe", "restaurant", "fast food", "food"]
SUMMER_MONTHS = [6, 7, 8, 9]
SUMMER_CITY, HOME_CITY = "Burgas", "Sofia"
