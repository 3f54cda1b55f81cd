"""Literal pools and key arithmetic of the candidate fixture.

The driver's tables hold no candidate profiles, so candidates are derived from
``customer`` / ``orders`` / ``lineitem`` by integer arithmetic on their keys and
these phrase pools (picked with ``pool[expr % len(pool)]``).  The pools are
chosen so that every taxonomy branch fires somewhere.  The same description is
rendered twice: as Spark DataFrame code (``bridge.py``) and as DuckDB SQL
(``plans/oracle.py``).
"""

TITLES = (
    "ML Engineer", "Senior ML Engineer", "Data Scientist", "Software Engineer",
    "Marketing Manager", "AI Engineer", "Backend Engineer", "HR Manager",
    "Senior Data Scientist", "Data Engineer", "QA Engineer", "Research Engineer",
    "Product Designer", "Lead Data Scientist", "Sales Executive", "NLP Engineer",
    "Junior ML Engineer", "Business Analyst", "Staff Platform Engineer", "Retail Associate",
)

COMPANIES = (
    "Google", "Flipkart", "TCS", "Swiggy", "Infosys", "Acme Analytics", "Razorpay",
    "Wipro", "Nimbus Labs", " Microsoft ", "Accenture", "Zomato", "Cognizant",
)

CONSULTING = ("TCS", "Infosys", "Wipro", "Accenture", "Cognizant")

DESCRIPTIONS = (
    "Built and deployed a real-time ML ranking service in production for 10 million users with low latency",
    "Designed hybrid search and semantic search with embeddings, BM25 and FAISS for retrieval; tuned NDCG and MRR",
    "Published paper at a top venue; thesis on theoretical models in an academic lab with arxiv preprints",
    "Prototyped chatbots with LangChain and the OpenAI API using prompt template tricks",
    "Improved the job search page and built tools to search for candidates",
    "Owned the product roadmap and the storage migration of the platform",
    "Managed vendor accounts, payroll and quarterly reports",
    "Built a recommendation engine with candidate generation and learning to rank; A/B testing and model serving on Kubernetes and Docker in AWS",
    "Trained deep learning models for image classification; monitoring and alerting with CI/CD",
)

INDUSTRIES = ("Technology", "Finance", "Retail", "Consulting", "Healthcare", "E-commerce")

SKILLS = (
    "Python", "PyTorch", "FAISS", "Elasticsearch", "Embeddings", "BM25",
    "Learning to Rank", "XGBoost", "LoRA", "OpenCV", "Photoshop", "SEO",
    "Docker", "SQL", "Excel", "Sentence-Transformers", "Computer Vision",
)

LEVELS = ("beginner", "intermediate", "Advanced", "expert")

DEGREES = ("B.Tech", "M.Tech", "Ph.D", "MBA", "Diploma", "BBA", "B.Sc", "M.S.")

TIERS = ("tier_1", "tier_2", "tier_3", "tier_4", "unknown")

FIELDS = (
    "Computer Science", "Information Technology", "Mechanical Engineering", "Data Science",
    "Commerce", "Artificial Intelligence", "Physics", "Machine Learning",
)

HEADLINES = (
    "Search and ranking engineer", "ML engineer building retrieval systems", "Data professional",
    "Marketing lead", "Backend developer", "Researcher in NLP",
)

LOCATIONS = (
    "Pune, Maharashtra", "Noida, Uttar Pradesh", "Bangalore, Karnataka", "Hyderabad, Telangana",
    "Jaipur, Rajasthan", "Kochi, Kerala", "London", "Singapore",
)
COUNTRIES = ("India", "India", "India", "India", "India", "India", "United Kingdom", "Singapore")

COMPANY_SIZES = ("1-10", "11-50", "51-200", "201-500", "501-1000", "1001-5000", "5001-10000", "10001+")

NOTICE_DAYS = (0, 15, 30, 45, 60, 75, 90, 120, 150, 180)

LANGUAGE_LEVELS = ("basic", "conversational", "professional", "native", "fluent")

WORK_MODES = ("remote", "hybrid", "onsite", "flexible", "")

BLOCK = 23                        # order keys dealt together
BLOCK_CUTS = (1, 3, 6, 12, 23)    # to candidates of 1, 2, 3, 6 and 11 jobs
ORDER_ITEMS = 24                  # line items of one order that one candidate gets, about
