"""Settings of the ranking engine.

Every taxonomy, weight and threshold is a field of :class:`RankConfig`, so a
caller can override any of them; the defaults are the values the ranking
semantics were defined with.  Operators receive the config object and turn the
values into literal Spark expressions (``InSet`` for sets, ``CaseWhen`` for
ladders), so Catalyst constant-folds them and nothing is shipped per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the behaviour being reproduced; they are
# data, listed plainly and in their natural order.
# ---------------------------------------------------------------------------

ENGINEERING_TITLES = (
    "ai engineer", "ml engineer", "machine learning engineer",
    "senior ai engineer", "senior ml engineer", "data scientist",
    "senior data scientist", "lead data scientist", "nlp engineer",
    "research engineer", "applied scientist", "software engineer",
    "senior software engineer", "backend engineer", "platform engineer",
    "data engineer", "senior data engineer", "deep learning engineer",
    "computer vision engineer", "junior ml engineer", "junior ai engineer",
    "senior machine learning engineer",
)

NON_ENGINEERING_TITLES = (
    "marketing manager", "operations manager", "hr manager",
    "sales executive", "accountant", "content writer",
    "graphic designer", "project manager", "business analyst",
    "mechanical engineer", "civil engineer", "chemical engineer",
    "customer support", "qa engineer", "recruiter",
)

PRODUCTION_KEYWORDS = (
    "production", "deployed", "shipped", "served", "real-time",
    "end-to-end", "a/b test", "a/b testing", "online experiment",
    "latency", "throughput", "scaled to", "million users",
    "inference", "model serving", "feature store", "ci/cd",
    "monitoring", "alerting", "api endpoint", "microservice",
    "kubernetes", "docker", "aws", "gcp", "azure",
)

RETRIEVAL_KEYWORDS = (
    "retrieval", "ranking", "search", "recommendation",
    "embeddings", "vector search", "vector database",
    "semantic search", "hybrid search", "re-ranking",
    "bm25", "tf-idf", "inverted index", "ndcg", "mrr",
    "map", "recall@k", "precision@k", "candidate generation",
    "matching", "relevance", "information retrieval",
    "learning to rank", "sentence-transformers", "bi-encoder",
    "cross-encoder", "faiss", "pinecone", "weaviate", "qdrant",
    "milvus", "elasticsearch", "opensearch", "chromadb", "rag",
    "retrieval augmented generation",
)

RESEARCH_KEYWORDS = (
    "published paper", "thesis", "phd research", "academic lab",
    "research assistant", "journal", "conference paper",
    "arxiv", "no production", "theoretical",
)

WRAPPER_KEYWORDS = (
    "langchain", "llamaindex", "openai api", "chatgpt",
    "gpt wrapper", "prompt template",
)

CONSULTING_FIRMS = (
    "tcs", "infosys", "wipro", "accenture", "cognizant",
    "capgemini", "hcl", "tech mahindra", "deloitte", "mphasis",
    "ltimindtree", "mindtree", "ibm", "ey", "kpmg", "pwc",
    "mckinsey", "bain", "bcg",
)

# The original list also names the hosting platform itself as its last entry;
# that name is left out of the default here (add it through the config).
PRODUCT_COMPANIES = (
    "google", "meta", "facebook", "amazon", "microsoft",
    "apple", "netflix", "flipkart", "swiggy", "zomato",
    "razorpay", "cred", "phonepe", "paytm", "ola", "uber",
    "grab", "gojek", "linkedin", "twitter", "x", "snap",
    "salesforce", "adobe", "nvidia", "intel", "stripe",
    "square", "airbnb", "spotify", "databricks", "snowflake",
    "confluent", "samsung", "qualcomm", "oracle", "meesho",
    "myntra", "nykaa", "freshworks", "zoho", "postman",
    "atlassian", "slack", "notion",
)

MUST_HAVE_SKILLS = (
    "sentence transformers", "sentence-transformers",
    "openai embeddings", "bge", "e5", "embeddings",
    "embedding", "word2vec", "fasttext", "bert", "pinecone",
    "weaviate", "qdrant", "milvus", "faiss", "elasticsearch",
    "opensearch", "chromadb", "python", "ndcg", "mrr", "map",
    "ranking evaluation",
)

NICE_TO_HAVE_SKILLS = (
    "lora", "qlora", "peft", "fine-tuning", "fine-tuning llms",
    "xgboost", "lightgbm", "learning to rank", "distributed systems",
    "onnx", "tensorrt", "triton",
)

IRRELEVANT_SKILLS = (
    "opencv", "image classification", "object detection",
    "cnn", "gans", "computer vision", "yolo", "speech recognition",
    "tts", "asr", "robotics", "ros", "slam", "solidworks",
    "autocad", "ansys", "photoshop", "illustrator", "figma",
    "seo", "content writing", "sales", "accounting", "six sigma",
    "sap",
)

PREFERRED_CITIES = ("pune", "noida")

TIER1_CITIES = (
    "mumbai", "delhi", "bangalore", "bengaluru", "hyderabad",
    "chennai", "gurgaon", "gurugram", "kolkata", "ahmedabad",
)

AI_TITLE_WORDS = ("ai", "ml", "machine learning", "data scientist", "nlp", "deep learning")
SENIOR_TITLE_WORDS = ("senior", "lead", "principal", "staff", "head")
ML_WORDS = ("ml", "ai", "model", "algorithm", "machine learning", "nlp", "embeddings")
RETRIEVAL_CORE_WORDS = ("retrieval", "search", "ranking")
SEARCH_FALSE_POSITIVES = ("job search", "search for")
RELEVANT_FIELDS = (
    "computer science", "artificial intelligence", "machine learning",
    "data science", "information technology",
)
GRAD_DEGREES = ("ph.d", "phd", "m.tech", "m.s.", "m.sc", "m.e.")

DEGREE_RANK = (
    ("ph.d", 5), ("phd", 5),
    ("m.tech", 4), ("m.s.", 4), ("m.sc", 4), ("m.e.", 4), ("mba", 4),
    ("b.tech", 3), ("b.e.", 3), ("b.sc", 3),
    ("diploma", 2),
)
TIER_RANK = (("tier_1", 4), ("tier_2", 3), ("tier_3", 2), ("tier_4", 1), ("unknown", 0))
TIER_NUMBER = (("tier_1", 1), ("tier_2", 2), ("tier_3", 3), ("tier_4", 4), ("unknown", 4))
TIER_SCORE = ((1, 1.0), (2, 0.8), (3, 0.5), (4, 0.3))
WORKMODE_SCORE = (("onsite", 0.9), ("hybrid", 1.0), ("flexible", 1.0), ("remote", 0.7))

# notice-period ladder: (upper bound in days, score); beyond the last → 0.1
NOTICE_LADDER = ((30, 1.0), (60, 0.8), (90, 0.5), (120, 0.3))
NOTICE_DEFAULT = 0.1
# recency ladder: (max days since active, score); beyond → 0.1
RECENCY_LADDER = ((7, 1.0), (30, 0.9), (60, 0.7), (90, 0.5), (180, 0.3))
RECENCY_DEFAULT = 0.1
# response-time ladder: (max hours, factor); beyond → 0.5
RESPONSE_TIME_LADDER = ((12, 1.0), (48, 0.9), (96, 0.7))
RESPONSE_TIME_DEFAULT = 0.5

# integrity rule weights, in rule order 1..8
RULE_WEIGHTS = (0.4, 0.3, 0.5, 0.3, 0.2, 0.3, 0.2, 0.2)

# top-10 audit: titles that should not appear near the top
AUDIT_NON_ENG_TITLES = (
    "marketing manager", "operations manager", "hr manager",
    "sales executive", "accountant", "content writer",
    "graphic designer", "customer support", "civil engineer",
    "mechanical engineer",
)

# dataset-profile skill groups and its own (shorter) consulting list
PROFILE_SKILL_GROUPS = (
    ("embeddings", ("sentence transformers", "openai embeddings", "bge", "e5", "embeddings", "sentence-transformers")),
    ("vector_db", ("pinecone", "weaviate", "qdrant", "milvus", "faiss", "elasticsearch", "opensearch", "chromadb")),
    ("llm", ("fine-tuning llms", "lora", "qlora", "peft", "llm", "rag", "langchain", "prompt engineering")),
    ("retrieval", ("bm25", "information retrieval", "search", "ranking", "recommendation systems", "ndcg", "mrr")),
    ("python", ("python",)),
    ("ml_general", ("pytorch", "tensorflow", "scikit-learn", "xgboost", "machine learning", "deep learning", "nlp", "transformers")),
)
PROFILE_CONSULTING = (
    "tcs", "infosys", "wipro", "accenture", "cognizant", "capgemini", "hcl",
    "tech mahindra", "deloitte", "ibm", "mphasis", "ltimindtree", "mindtree",
)
PROFILE_CS_FIELDS = ("computer science", "artificial intelligence", "machine learning", "data science")
# experience histogram: (upper bound exclusive, label); the rest → "15+"
EXPERIENCE_BINS = ((2, "0-2"), (4, "2-4"), (6, "4-6"), (8, "6-8"), (10, "8-10"), (12, "10-12"), (15, "12-15"))
EXPERIENCE_TOP_BIN = "15+"

# submission contract
SUBMISSION_HEADER = ("candidate_id", "rank", "score", "reasoning")
CANDIDATE_ID_PATTERN = "^CAND_[0-9]{7}$"


@dataclass(frozen=True)
class RankConfig:
    """All knobs of the pipeline, defaulting to the fixed values above."""

    engineering_titles: tuple = ENGINEERING_TITLES
    non_engineering_titles: tuple = NON_ENGINEERING_TITLES
    production_keywords: tuple = PRODUCTION_KEYWORDS
    retrieval_keywords: tuple = RETRIEVAL_KEYWORDS
    research_keywords: tuple = RESEARCH_KEYWORDS
    wrapper_keywords: tuple = WRAPPER_KEYWORDS
    consulting_firms: tuple = CONSULTING_FIRMS
    product_companies: tuple = PRODUCT_COMPANIES
    must_have_skills: tuple = MUST_HAVE_SKILLS
    nice_to_have_skills: tuple = NICE_TO_HAVE_SKILLS
    irrelevant_skills: tuple = IRRELEVANT_SKILLS
    preferred_cities: tuple = PREFERRED_CITIES
    tier1_cities: tuple = TIER1_CITIES

    ideal_years: float = 7.0
    ideal_years_sigma: float = 2.0
    ideal_range: tuple = (5.0, 9.0)
    too_junior_below: float = 2.0
    too_senior_above: float = 15.0

    # integrity rules
    rule_weights: tuple = RULE_WEIGHTS
    current_year: int = 2026
    honeypot_threshold: float = 0.7
    suspicious_threshold: float = 0.6
    include_title_rule: bool = True

    # behaviour
    reference_date: str = "2026-06-01"
    missing_activity_date: str = "2020-01-01"
    component_weights: tuple = (0.25, 0.30, 0.20, 0.15, 0.10)
    score_floor: float = 0.1
    score_ceiling: float = 1.0

    # ranking
    top_k: int = 100
    suspicion_penalty: float = 0.5
    score_decimals: int = 4
    max_reasoning_chars: int = 300
    minor_concern_rank: int = 30

    # seconds after which a ranking run warns
    budget_seconds: float = 270.0

    # key under which the behavioural signals sit in a candidate record
    signals_key: str = "signals"

    def with_(self, **changes) -> "RankConfig":
        return replace(self, **changes)


DEFAULT = RankConfig()


@dataclass(frozen=True)
class RubricConfig:
    """Deterministic teacher that stands in for the external labeller."""

    title_weight: float = 0.35
    retrieval_weight: float = 0.25
    production_weight: float = 0.15
    band_weight: float = 0.15
    product_weight: float = 0.10
    saturation: int = 3
    consulting_cap: int = 2
    offdomain_cap: int = 2
    offdomain_min_irrelevant: int = 3
    stuffer_cap: int = 1
    stuffer_min_must_have: int = 4
    inactive_days: int = 180
    inactive_penalty: int = 1


@dataclass(frozen=True)
class TrainConfig:
    """Gradient-boosted regression settings (MLlib names)."""

    max_iter: int = 300
    max_labels: int = 20_000     # labelled rows that a fit and its cross-validation use at most
    max_depth: int = 6
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    min_instances_per_node: int = 3
    seed: int = 42
    folds: int = 5
    fold_seed: str = "42"
    label_col: str = "llm_score"
    extra: dict = field(default_factory=dict)
