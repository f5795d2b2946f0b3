"""Word lists, vocabularies and starter seeds.

Results depend on these exact values, so they are stated plainly here and nowhere else.
"""

# --- fixed values: pain gate and sentiment ---------------------------------------------------
PAIN_PHRASES = [
    "wish", "hate", "frustrated", "need better", "alternative to", "struggling with", "pain point",
]
NEGATIVE_WORDS = [
    "hate", "frustrated", "annoying", "broken", "bad", "worst", "bug", "issue", "problem", "pain",
    "difficult", "slow", "useless", "terrible", "awful", "fail", "missing",
]
POSITIVE_WORDS = [
    "love", "great", "awesome", "good", "excellent", "amazing", "helpful", "perfect", "happy", "easy",
]
WILLINGNESS_CUES = ["pay", "pricing", "cost", "subscription", "expensive", "budget", "charge", "price"]

# --- fixed values: source gates --------------------------------------------------------------
MARKET_TERMS = [
    "alternative", "alternatives", "compare", "comparison", "review", "reviews", "pricing", "price",
    "pros", "cons", "buyer", "buyers", "software", "saas", "market", "vendor", "best", "top",
]
JOB_WILLINGNESS_TERMS = ["budget", "hourly", "fixed-price", "pay", "payment", "cost", "usd", "$"]
JOB_INEFFICIENCY_TERMS = [
    "manual", "spreadsheet", "copy paste", "repetitive", "entry", "automation", "integrat", "need",
]
FORUM_PROBLEM_TERMS = ["problem", "issue", "struggl", "friction", "manual", "slow", "pain"]
BLOCKED_TERMS = ["just a moment", "cloudflare", "captcha"]
JOB_NODE_HINTS = [
    "title", "jobTitle", "description", "summary", "snippet", "jobPostingUrl", "jobUrl", "id", "jobId",
    "jobPostingId", "hourlyBudgetMin", "hourlyBudgetMax", "amount",
]

# --- fixed values: term extraction and tags --------------------------------------------------
STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "been", "being", "but", "by", "can", "cannot", "could",
    "did", "do", "does", "doing", "for", "from", "had", "has", "have", "having", "he", "her", "here",
    "hers", "him", "his", "how", "i", "if", "in", "into", "is", "it", "its", "itself", "just", "me",
    "more", "most", "my", "no", "not", "of", "on", "or", "our", "ours", "please", "she", "so", "some",
    "than", "that", "the", "their", "them", "there", "these", "they", "this", "those", "to", "too", "us",
    "very", "was", "we", "were", "what", "when", "where", "which", "who", "why", "will", "with", "would",
    "you", "your", "yours",
    "app", "apps", "software", "tool", "tools", "issue", "issues", "problem", "problems", "need", "better",
]
GENERIC_TAGS = ["general", "unknown", "misc", "miscellaneous", "other", "n/a"]
LOCATIONS = [
    "africa", "asia", "australia", "canada", "china", "europe", "france", "germany", "india",
    "indonesia", "italy", "japan", "latin america", "mexico", "new zealand", "singapore", "spain",
    "uk", "united kingdom", "united states", "usa", "us", "uae", "brazil", "argentina", "chile",
    "colombia", "peru", "nigeria", "kenya", "egypt", "saudi arabia", "dubai", "delhi", "mumbai",
    "bangalore", "london", "paris", "berlin", "toronto", "vancouver", "sydney", "melbourne",
    "california", "new york", "texas", "washington", "florida", "european", "american", "indian",
    "canadian", "british",
]
LOCATION_SUFFIXES = [" city", " county", " state", " province", " region"]
LOCATION_CODES = ["us", "uk", "in", "ca", "au"]

# --- fixed values: labels --------------------------------------------------------------------
SOURCE_LABELS = [
    "play_store", "app_store", "reddit", "hacker_news", "product_hunt", "g2", "capterra", "upwork",
]
SOURCE_BOOST = {1: 0.0, 2: 10.0, 3: 18.0, 4: 24.0, 5: 30.0, 6: 35.0}
WILLINGNESS_FLOOR = {"low": 30.0, "medium": 55.0, "high": 78.0}
PRICING_HINTS = {
    "high": "$49-$199/mo per team", "medium": "$19-$79/mo per team", "low": "$9-$29/mo starter",
}
TRUE_TEXTS = ["1", "true", "yes", "y", "on"]

# --- fixed values: seed error rules ----------------------------------------------------------
BLOCKED_ERROR_TEXTS = ["403", "captcha", "cloudflare", "expecting value"]
BEST_EFFORT_SEED_TYPES = ["g2", "capterra", "upwork", "hackernews", "producthunt"]
APP_GONE_TEXTS = ["not reachable", "404", "not found", "unavailable"]
PLAY_GONE_TEXTS = ["not found", "404", "package", "cannot fetch", "unavailable"]
APPLE_GONE_TEXTS = ["not reachable", "404", "not found", "unavailable"]
COMMUNITY_GONE_TEXTS = ["forbidden", "not found", "too many requests", "403", "404", "429"]
STATIC_SEED_TYPES = ["apps", "hackernews", "producthunt", "g2", "capterra", "upwork"]

# --- fixed values: starter seeds -------------------------------------------------------------
STARTER_COMMUNITIES = [
    "startups", "entrepreneur", "smallbusiness", "juststart", "growmybusiness", "indiehackers", "buildinpublic",
    "sideproject", "startupideas", "startup", "techstartups", "solopreneur", "entrepreneurridealong",
    "smallbusinessowners", "business", "saas", "microsaas", "saasgrowth", "saasindia", "saastools", "b2bsaas",
    "saasmarketing", "software", "startupmarketing", "appideas", "freelance", "freelancing", "antiwork", "jobs",
    "cscareerquestions", "work", "remote", "digitalnomad", "agencylife", "remotejobs", "workonline", "forhire",
    "hiring", "overemployed", "careers", "productivity", "notion", "obsidianmd", "excel", "productivitytools",
    "getdisciplined", "onenote", "evernote", "taskmanagement", "selfimprovement", "automation", "marketing", "sales",
    "growthhacking", "ecommerce", "shopify", "seo", "bigseo", "ppc", "dropshipping", "etsy", "socialmedia",
    "socialmediamarketing", "emailmarketing", "content_marketing", "copywriting", "affiliate_marketing", "salesops",
    "customerexperience", "webdev", "learnprogramming", "sysadmin", "devops", "dataisbeautiful", "programming",
    "coding", "technology", "frontend", "backend", "python", "javascript", "reactjs", "node", "cloudcomputing", "aws",
    "machinelearning", "datascience", "dataanalytics", "analytics", "artificial", "cybersecurity", "linux",
    "softwarearchitecture", "personalfinance", "accounting", "bookkeeping", "tax", "smallbusinessuk",
    "financialindependence", "operations", "projectmanagement", "legaladvice", "legaladviceindia", "crm", "hr",
    "developersindia", "indianstartup", "indiainvestments", "smallbusinessindia", "entrepreneurindia", "india",
    "desitrading", "india_tax", "indianjobs", "startupsindia", "teachers", "homeautomation", "urbanfarming",
    "warehousing", "travelhacks", "photography", "healthcare", "resumes", "careerguidance", "androidapps", "iphone",
    "apps", "offmychest", "confession", "findapath", "wordpress", "nocode", "customer_success", "edtech", "logistics",
]
STARTER_APPS = [
    ("Evernote", "com.evernote", "281796108", "Productivity"),
    ("Todoist", "com.todoist", "572688870", "Productivity"),
    ("Notion", "notion.id", "1232780281", "Productivity"),
    ("Slack", "com.Slack", "618783545", "Communication"),
    ("Trello", "com.trello", "461504587", "Project Management"),
]
STARTER_JOB_QUERIES = [
    ("manual data entry excel", "Operations"), ("copy paste crm", "CRM"),
    ("lead generation spreadsheet", "Sales"), ("shopify order processing", "Ecommerce"),
    ("inventory reconciliation", "Operations"), ("bookkeeping automation", "Finance"),
    ("invoice processing", "Finance"), ("customer support ticket triage", "Support"),
    ("social media reporting", "Marketing"), ("seo reporting dashboard", "Marketing"),
    ("notion automation", "Productivity"), ("zapier automation cleanup", "Automation"),
    ("email list cleaning", "Marketing"), ("recruiting pipeline tracking", "HR"),
    ("project status reporting", "Project Management"), ("warehouse spreadsheet tracking", "Logistics"),
    ("appointment scheduling assistant", "Scheduling"), ("content calendar management", "Marketing"),
    ("dashboard data consolidation", "Analytics"), ("subscription churn analysis", "SaaS"),
]
STARTER_FORUM_QUERIES = [
    ("manual process", "Operations"), ("spreadsheet workflow", "Operations"), ("crm", "CRM"),
    ("ticket triage", "Support"), ("automation", "Automation"), ("project management", "Project Management"),
    ("accounting", "Finance"), ("bookkeeping", "Finance"), ("sales ops", "Sales"),
    ("inventory", "Logistics"), ("email marketing", "Marketing"), ("content workflow", "Marketing"),
]
STARTER_LAUNCH_QUERIES = [
    ("automation", "Automation"), ("productivity", "Productivity"), ("crm", "CRM"),
    ("customer support", "Support"), ("project management", "Project Management"),
    ("analytics", "Analytics"), ("scheduling", "Scheduling"), ("bookkeeping", "Finance"),
]
FALLBACK_PRODUCTS = [
    ("Notion", "Productivity"), ("Asana", "Project Management"), ("ClickUp", "Project Management"),
    ("Monday.com", "Project Management"), ("Airtable", "Database"), ("HubSpot", "CRM"),
    ("Salesforce", "CRM"), ("Pipedrive", "CRM"), ("Zoho CRM", "CRM"), ("Freshsales", "CRM"),
    ("Jira", "Development"), ("Linear", "Development"), ("Confluence", "Documentation"),
    ("Slack", "Communication"), ("Microsoft Teams", "Communication"), ("Zoom", "Communication"),
    ("Loom", "Communication"), ("Canva", "Design"), ("Figma", "Design"), ("Miro", "Collaboration"),
    ("Intercom", "Support"), ("Zendesk", "Support"), ("Freshdesk", "Support"), ("Typeform", "Forms"),
    ("SurveyMonkey", "Forms"), ("Mailchimp", "Marketing"), ("Klaviyo", "Marketing"), ("Semrush", "SEO"),
    ("Ahrefs", "SEO"), ("Shopify", "Ecommerce"), ("WooCommerce", "Ecommerce"), ("Stripe", "Payments"),
    ("QuickBooks", "Accounting"), ("Xero", "Accounting"), ("Wave", "Accounting"),
    ("Calendly", "Scheduling"), ("Trello", "Project Management"), ("Todoist", "Productivity"),
    ("Evernote", "Productivity"), ("Obsidian", "Productivity"), ("Zapier", "Automation"),
    ("Make", "Automation"), ("Bubble", "No Code"), ("Webflow", "No Code"), ("WordPress", "CMS"),
]

# --- fixed values: seed query vocabularies ---------------------------------------------------
STORE_QUERY_TERMS = [
    "productivity", "project management", "crm", "sales", "marketing", "email", "customer support",
    "helpdesk", "notetaking", "calendar", "todo", "task management", "automation", "workflow", "analytics",
    "dashboard", "bookkeeping", "accounting", "invoice", "expense", "inventory", "warehouse", "logistics",
    "shipping", "ecommerce", "shopify", "woocommerce", "dropshipping", "social media", "seo", "ppc",
    "content", "developer tools", "devops", "cloud", "security", "vpn", "ai assistant", "ai chatbot",
    "ai writing", "no code", "website builder", "wordpress", "notion", "slack", "jira", "kanban",
    "collaboration", "remote work", "education", "healthcare", "fitness", "finance", "banking", "payments",
    "subscription", "saas", "recruiting", "hr", "payroll", "scheduling", "appointment", "point of sale",
    "restaurant", "hotel", "travel",
]
STORE_QUERY_SUFFIXES = [
    "app", "software", "tool", "platform", "for business", "for startups", "for teams", "for agencies",
    "for freelancers", "for creators", "for ecommerce", "for smb", "for enterprise", "india", "global",
]
JOB_VERBS = [
    "automation", "management", "tracking", "reporting", "optimization", "cleanup", "migration",
    "integration", "consolidation", "analysis", "monitoring", "validation", "synchronization", "auditing",
    "reconciliation",
]
JOB_TASKS = [
    "manual data entry", "copy paste", "lead generation", "crm updates", "invoice processing",
    "bookkeeping", "inventory updates", "order processing", "email outreach", "support ticket triage",
    "calendar coordination", "excel reporting", "dashboard updates", "social media reporting",
    "seo reporting", "recruiting pipeline", "project status updates", "timesheet processing",
    "billing operations", "vendor management", "qa checklist",
]
JOB_DOMAINS = [
    "for shopify stores", "for agencies", "for startups", "for ecommerce brands", "for saas teams",
    "for small businesses", "for sales teams", "for support teams", "for operations teams",
    "for finance teams", "for recruitment agencies", "for healthcare clinics", "for education businesses",
    "for logistics companies",
]
JOB_CATEGORY_RULES = [
    ("crm", "CRM"), ("invoice", "Finance"), ("bookkeeping", "Finance"), ("support", "Support"),
    ("seo", "Marketing"), ("social", "Marketing"), ("shopify", "Ecommerce"), ("inventory", "Operations"),
    ("recruit", "HR"), ("data", "Operations"),
]

# --- fixed values: patterns of forum pages ---------------------------------------------------
FORUM_ROW = r"""(?is)<tr[^>]*class=['"][^'"]*athing[^'"]*['"][^>]*>.*?</tr>"""
FORUM_TITLE = r"""(?is)<span[^>]+class=['"]titleline['"][^>]*>\s*<a[^>]+href=['"]([^'"]+)['"][^>]*>(.*?)</a>"""
FORUM_ROW_ID = r"""(?i)id=['"](\d+)['"]"""
FORUM_COMMENT = r"""(?is)<span[^>]+class=['"]commtext[^'"]*['"][^>]*>(.*?)</span>"""
FORUM_NEW_COMMENT = r"""(?is)<tr[^>]+class=['"]athing['"][^>]+id=['"](\d+)['"][^>]*>.*?<span[^>]+class=['"]onstory['"][^>]*>.*?<a[^>]+href=['"]([^'"]+)['"][^>]*>(.*?)</a>.*?<div[^>]+class=['"]comment['"][^>]*>\s*<div[^>]+class=['"]commtext[^'"]*['"][^>]*>(.*?)</div>"""
# --- end of the fixed values -----------------------------------------------------------------
