"""Rule dictionaries. Results depend on each word, on order, and on spelling."""

# Words looked up in a domain's first label.
DOMAIN_KEYWORDS = [
    "beauty", "skin", "derma", "glow", "cosmetics", "glam", "care", "lash", "hair", "salon", "aura", "luxe", "pure", "face",
    "kids", "baby", "child", "tots", "little", "junior", "mama", "toy", "play", "tiny", "cradle", "mom",
    "wear", "style", "vogue", "thread", "apparel", "outfit", "stitch", "trend", "closet", "garb", "kicks",
    "tech", "saas", "ai", "app", "labs", "api", "dev", "cloud", "cyber", "data", "hq", "soft", "code", "byte", "stack", "bot", "sync", "flow",
    "pet", "paw", "tail", "vet", "bark", "fur", "meow", "hound",
    "home", "decor", "living", "space", "nest", "craft", "furn", "wood", "casa", "room", "vibe",
    "shop", "store", "cart", "buy", "mart", "brand", "goods", "deal", "loot", "retail",
    "health", "fit", "med", "clinic", "cure", "gym", "wellness", "dental", "nutra", "diet", "vital", "protein",
    "pay", "fin", "wealth", "invest", "capital", "fund", "trade", "crypto", "coin", "mint", "tax", "bank",
    "realty", "estate", "prop", "homes", "build", "infra", "arch", "land", "agency", "studio", "media", "consult", "partners", "group", "growth", "creative", "event", "wed", "bliss",
    "food", "eats", "brew", "cafe", "farm", "fresh", "bite", "agro", "dine", "snack", "sip", "learn", "edu", "academy", "skill", "prep", "brain", "tutor", "class",
]

# Suffixes of a domain.
DOMAIN_SUFFIXES = [".in", ".com", ".co", ".co.in", ".io", ".ai", ".app", ".tech", ".health", ".store", ".shop", ".so", ".gg", ".net", ".org", ".co.uk", ".us"]

# Business labels in order, each with the phrases of which one is enough.
BUSINESS = [
    ("💻 SaaS / Software", ["free trial", "start free", "book a demo", "request a demo", "schedule a demo", "dashboard", "login", "sign up free", "api", "integration", "software", "platform", "saas", "automate", "workflow", "crm", "erp", "subscription plan", "monthly plan", "annual plan", "upgrade plan"]),
    ("🚀 Startup", ["join the waitlist", "join waitlist", "get early access", "early access", "we are building", "we're building", "backed by", "seed round", "series a", "pre-seed", "in beta", "beta access", "founding team", "we raised", "investor", "venture", "launching soon", "notify me when"]),
    ("📦 Physical Product Brand", ["add to cart", "add to bag", "buy now", "shop now", "shop the collection", "free shipping", "order now", "in stock", "out of stock", "checkout", "collection", "all products", "new arrivals", "best sellers", "shop all", "cod available", "cash on delivery", "track your order", "return policy"]),
    ("🛠️ Service Based", ["book a call", "book a free call", "get a quote", "free quote", "hire us", "our services", "what we do", "our work", "case studies", "consultation", "agency", "we help", "we specialize", "our process", "portfolio", "client results", "work with us", "let's talk", "get in touch"]),
]
BUSINESS_ELSE = "❓ Unclear"

# Product labels in order, each with the words of which one is enough.
PRODUCT = [
    ("👗 Fashion & Apparel", ["clothing", "fashion", "apparel", "wear", "outfit", "dress", "shirt", "t-shirt", "hoodie", "shoes", "sneakers", "footwear", "collection", "wardrobe", "streetwear", "ethnic wear", "kurta", "saree"]),
    ("💄 Beauty & Skincare", ["skincare", "beauty", "serum", "moisturizer", "cosmetic", "glow", "hair care", "shampoo", "conditioner", "lip", "foundation", "makeup", "nail", "fragrance", "perfume", "sunscreen", "face wash"]),
    ("🍔 Food & Beverage", ["food", "snack", "beverage", "drink", "coffee", "tea", "nutrition", "protein", "chocolate", "biscuit", "sauce", "spice", "organic food", "health food", "meal", "recipe", "restaurant", "cafe", "bakery"]),
    ("🐾 Pets", ["pet", "dog", "cat", "paw", "fur", "vet", "animal", "puppy", "kitten", "pet food", "pet care", "grooming"]),
    ("🏠 Home & Decor", ["home decor", "furniture", "interior", "living room", "bedroom", "candle", "wall art", "cushion", "lamp", "rug", "curtain", "mattress", "sofa", "kitchen", "bathroom", "storage"]),
    ("💪 Health & Fitness", ["fitness", "gym", "supplement", "workout", "wellness", "yoga", "diet", "weight loss", "muscle", "protein powder", "pre workout", "health", "ayurved", "naturo", "immunity", "vitamin", "omega"]),
    ("👶 Kids & Baby", ["kids", "baby", "toddler", "children", "toy", "parenting", "infant", "newborn", "maternity", "diaper", "stroller", "school bag", "kids wear"]),
    ("💻 Tech & Gadgets", ["gadget", "device", "electronics", "wireless", "smart home", "charger", "earphone", "headphone", "laptop", "mobile", "phone case", "power bank", "camera", "drone", "wearable", "smartwatch"]),
    ("📚 Education & Coaching", ["course", "learn", "education", "training", "skill", "tutorial", "coaching", "mentor", "certification", "bootcamp", "masterclass", "workshop", "study", "exam prep", "upskill"]),
    ("💰 Finance & Fintech", ["invest", "finance", "crypto", "trading", "wealth", "insurance", "loan", "mutual fund", "stock", "portfolio", "fintech", "banking", "payment", "wallet", "tax", "accounting"]),
    ("🏡 Real Estate", ["real estate", "property", "flat", "apartment", "villa", "plot", "buy home", "rent", "commercial space", "office space", "realty", "housing"]),
    ("✈️ Travel & Hospitality", ["travel", "hotel", "resort", "holiday", "vacation", "tour", "trek", "adventure", "flight", "booking", "airbnb", "hospitality", "staycay"]),
    ("🎮 Gaming & Entertainment", ["gaming", "game", "esports", "streaming", "entertainment", "music", "podcast", "creator", "content", "media", "film", "video"]),
    ("🌿 Sustainable & Eco", ["sustainable", "eco", "organic", "green", "zero waste", "recyclable", "environment", "natural", "vegan", "cruelty free", "biodegradable"]),
]
PRODUCT_ELSE = "🌐 General / Other"

# Page features; each label needs one phrase of every list that stands with it.
STAGES = [("Pre-Launch", [["coming soon", "launching soon"]]), ("Shopify Password Page", [["password"], ["shopify"]]), ("Using Link-in-Bio", [["linktree", "bento.me"]])]
TECH = [("Meta Ads", [["fbq('init'", "facebook pixel"]]), ("Google Ads", [["gtag(", "google-analytics"]]), ("Shopify", [["shopify"]]), ("Webflow", [["webflow"]]), ("Klaviyo", [["klaviyo"]]), ("TikTok Ads", [["tiktok"], ["pixel"]])]
INTENT = [("E-Com", [["add to cart", "checkout"]]), ("SaaS/B2B", [["book a demo", "request demo"]])]
SOCIALS = [("Instagram", ["instagram.com"]), ("LinkedIn", ["linkedin.com/company"]), ("YouTube", ["youtube.com"]), ("Twitter/X", ["twitter.com", "x.com"]), ("Facebook", ["facebook.com"]), ("TikTok", ["tiktok.com"])]
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
EMAIL_DENIED = ["sentry", "wix", "example", "test", "domain"]
PHONE = r"(?:(?:\+|00)\d{1,3}[\s-]?)?(?:\(?\d{3}\)?[\s-]?)?\d{3}[\s-]?\d{4}"
PHRASE_BREAKS = "[.!?\n|•·]"

# What the labelling stage tells apart, and what it says of it.
PARKED = ["parked domain", "hostinger dns", "domain for sale", "buy this domain", "hugedomains", "sedoparking", "undeveloped", "welcome to nginx"]
PRELAUNCH = ["launching soon", "coming soon", "under construction", "check back for an update", "being worked on", "we're under construction", "opening soon", "be the first to know when we launch"]
STOP_WORDS = [
    "home", "about", "contact", "menu", "toggle", "navigation", "nav", "skip", "close", "open", "search", "cart", "login", "register",
    "signup", "next", "previous", "back", "read", "more", "click", "here", "cookie", "privacy", "policy", "terms", "copyright", "all",
    "rights", "reserved", "powered", "inc", "llc", "ltd", "password", "enter", "sign", "get", "started", "learn",
]
GENERAL = "🟢 6. General Contacts"
AGENCIES = "🛠️ 5. Service Agencies"
INSTANT = {
    "parked": (GENERAL, "Parked / No Website", "N/A"),
    "prelaunch": ("🔥 1. Pre-Launch", "Pre-Launch Brand", "Coming Soon"),
    "no_content": (GENERAL, "No Content Found", "N/A"),
}
REVIEW = "Review Manually"
LEADING_EMOJI = {"🍺": "🎬", "📝": "🛠️", "🎥": "🎬", "📱": "🤖", "💻": "🤖", "🏥": "🛠️", "🍔": "🛠️", "🏠": "🛠️", "🌿": "💰", "👗": "💰", "🎓": "🛠️", "⚖️": "🛠️"}
INVENTED_ROLES = ["author", "blogger", "writer", "poet"]
NICHES = [
    ("Healthcare", ["health", "medical", "clinic", "doctor", "pharma", "dental"]),
    ("Fitness", ["fitness", "gym", "sport", "athlet", "workout"]),
    ("Fashion", ["fashion", "cloth", "wear", "apparel", "textile"]),
    ("Food & Beverage", ["food", "restaurant", "cafe", "dining", "kitchen", "catering"]),
    ("Tech", ["tech", "software", "saas", "ai", "digital", "cloud"]),
    ("Real Estate", ["real estate", "property", "realty", "housing"]),
    ("Marketing", ["market", "agency", "seo", "ads", "creative"]),
    ("Education", ["educat", "school", "learn", "tutor", "academy"]),
    ("Beauty", ["beauty", "skin", "cosmetic", "salon", "hair"]),
    ("Legal", ["legal", "law", "lawyer", "attorney"]),
    ("Finance", ["finance", "invest", "wealth", "banking", "insurance"]),
]

# The lead record and the final table.
LEAD_COLUMNS = ["Domain", "Brand_Stage", "Title", "Meta_Description", "Page_Text", "Emails", "Phones", "Socials_Found", "Tech_Stack_Ads", "Intent_Trust", "Business_Type", "Product_Category"]
CLASS_ORDER = ["prelaunch", "parked", "no_content", "ai"]
LABEL_COLUMNS = ["Pitch_Category", "Business_Type", "Product_Category"]
MISSING, LIVE = "None", "Live"
BATCH_SIZE, MAX_WORDS, MAX_REPEATS = 5, 80, 2
CONNECT_TIMEOUT, READ_TIMEOUT, FETCH_THREADS, LIVE_STATUS = 4, 5, 60, 200
MODEL_TIMEOUT, MAX_RUNTIME, FILE_TIMEOUT = 90, 19800, 60
ATTEMPTS, BACK_OFF, LONG_WAIT = 3, 5, 15
CONTENT_PATH = "$.choices[0].message.content"
LINK_DENIED = ["whois-database-download", "contact"]
STALE_MARK, STALE_LENGTH, HEAD_LENGTH = "NO_DATA", 50, 200
EMPTY_CONTENT = 10
ASCII_SHARE, ASCII_LENGTH = 0.85, 10
