"""Label packs, lookup tables and thresholds shared by the operators.

Everything in this module is a fixed value: results must carry exactly these
strings and numbers.  Operators take them as default parameters, so another
institution can pass its own packs.
"""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: grading -------------------------------------------------
# (inclusive lower bound on the 10-point scale, value on the 4-point scale)
SCALE4_STEPS = (
    (8.5, 4.0),
    (8.0, 3.5),
    (7.0, 3.0),
    (6.5, 2.5),
    (5.5, 2.0),
    (5.0, 1.5),
    (4.0, 1.0),
)
SCALE4_TOP = 10.0

# --- fixed values: career fields and their subjects ------------------------
CAREER_FIELDS = {
    "AI / Data Science": ["17234", "17221", "17226", "17233"],
    "Web / Mobile Dev": ["17340", "17423", "17314", "17523", "17335"],
    "Network / Security": ["17506", "17212", "17332"],
    "Software Engineering": ["17427", "17434", "17426", "17432", "17236"],
    "Core / Foundation": ["17206", "17232", "17302", "17301", "17303", "17104"],
}
DEFAULT_FIELD = "Core / Foundation"
# The skills that stand for a field when jobs are matched.
FIELD_SKILLS = {
    "AI / Data Science": ["python", "machine learning", "data", "sql"],
    "Web / Mobile Dev": ["javascript", "react", "html", "css", "node", "php"],
    "Network / Security": ["network", "security", "aws", "docker"],
    "Software Engineering": ["java", "c#", "c++", "oop", "sql", "git"],
    "Core / Foundation": ["c", "linux", "system"],
}

# Role keywords, first matching field wins; no match means DEFAULT_FIELD.
ROLE_KEYWORDS = (
    ("Software Engineering", ("software", "fullstack", "backend")),
    ("AI / Data Science", ("data", "machine learning", "ai")),
    ("Web / Mobile Dev", ("web", "mobile", "frontend")),
    ("Network / Security", ("network", "security", "system", "devops")),
)

MARKET_CATEGORY = "IT"
UNKNOWN_NAME = "Unknown"
DEFAULT_FIELD_JOBS = 10

# --- fixed values: competitiveness -----------------------------------------
COMPETITIVENESS_STRONG = "Rất Lợi Thế (High Demand + High GPA)"
COMPETITIVENESS_FAIR = "Lợi thế khá (Đủ đáp ứng thị trường)"
COMPETITIVENESS_FIERCE = "Cạnh tranh khốc liệt (Cần cải thiện Điểm/Kỹ năng)"
COMPETITIVENESS_MEDIUM = "Trung bình"
NO_MARKET = "Không tìm thấy C.v Mới"

# --- fixed values: subject rules -------------------------------------------
SUBJECT_FEATURES = ["TB", "SD", "A+%", "A%", "B%", "C%", "D%", "F%", "MTC%", "TV"]
SUBJECT_NUMERIC = ["TB", "F%", "SD", "A%", "A+%"]

HARD, EASY, MEDIUM = "Khó", "Dễ", "Trung bình"
QUALITY_UNSTABLE = "Không ổn định / Cần cải thiện"
QUALITY_EVEN = "Tốt & đồng đều"
QUALITY_STABLE = "Ổn định"
QUALITY_NO_DATA = "Không đủ dữ liệu đánh giá"
TREND_UP, TREND_DOWN, TREND_FLAT = "Tích cực", "Tiêu cực", "Bình thường"

SUBJECT_CLUSTER_LABELS = ["Xuất sắc - Tốt", "Ổn định", "Không ổn định", "Tiêu cực - Kém"]
READINESS_LABELS = ["Sẵn sàng cao", "Đang phát triển", "Chưa sẵn sàng"]
UNKNOWN_LABEL = "Chưa xác định"

# label -> priority of the stand-alone lookup; any other label gets 1
LABEL_PRIORITY = {
    "Tiêu cực - Kém": 0,
    "Không ổn định": 2,
    "Ổn định": 1,
    "Xuất sắc - Tốt": 3,
}
LABEL_PRIORITY_DEFAULT = 1

# (substring of the quality label, priority, group label, row colour)
SUBJECT_GROUPS = (
    ("Tiêu cực", 0, "Tiêu cực – Cần lưu ý", "#fd7e7e"),
    ("Không ổn định", 1, "Không ổn định", "#fcd143"),
    ("Xuất sắc", 3, "Xuất sắc – Kết quả tốt", "#5eecb3"),
)
SUBJECT_GROUP_DEFAULT = (2, "Ổn định", "#c4b5fd")
# Badge background, foreground and icon by priority, and those of a subject that is not analysed.
SUBJECT_BADGES = {
    0: ("#ef4444", "#ffffff", "⚡"),
    1: ("#f59e0b", "#1c1917", "⚠️"),
    2: ("#8b5cf6", "#ffffff", "📘"),
    3: ("#10b981", "#ffffff", "✅"),
}
SUBJECT_BADGE_UNKNOWN = ("#c4b5fd", "#1e1b4b", "📋")

# priority -> header of the full list / of the filtered list
LIST_HEADERS = {
    0: "🔴  Tiêu Cực – Cần Lưu Ý",
    1: "🟡  Không Ổn Định",
    2: "🟣  Ổn Định",
    3: "🟢  Xuất Sắc – Kết Quả Tốt",
}
FILTER_HEADERS = {
    0: "🔴  Tiêu Cực – Cần Lưu Ý",
    1: "🟡  Không Ổn Định",
    2: "🟣  Bình Thường – Ổn Định",
    3: "🟢  Tích Cực – Kết Quả Tốt",
}

# --- fixed values: student clusters ----------------------------------------
RISK_ORDER = {2: 0, 0: 1, 3: 2, 1: 3}
CLUSTER_TAGS = {2: "danger", 0: "warning", 3: "good", 1: "excellent"}
CLUSTER_TAG_DEFAULT = "good"
DEFAULT_CLUSTER = 1
# row tags by readiness rank, best first
READINESS_RANK_TAGS = ["high", "med", "danger"]
# (lower-case substring, tag), first match wins
READINESS_TAGS = (
    ("rất sẵn sàng", "high"),
    ("sẵn sàng", "med"),
    ("cần cải thiện", "low"),
    ("chưa sẵn sàng", "danger"),
)
STUDENT_FEATURES = ["gpa", "std_score", "failed_subjects", "excellent_subjects"]
READINESS_FEATURES = ["gpa_tong", "TOEIC"]


class ClusterProfile(NamedTuple):
    cluster: int
    label: str
    risk: str
    color_tag: str
    badge_bg: str
    badge_fg: str
    icon: str
    gpa_range: str
    description: str
    reasons: list[str]
    suggestions: list[str]


# --- fixed values: texts shown for a student cluster -----------------------
CLUSTER_PROFILES = [
    ClusterProfile(
        cluster=2,
        label="Yếu – Nguy Cơ Cao",
        risk="🚨  Rủi ro cao",
        color_tag="danger",
        badge_bg="#ef4444",
        badge_fg="#ffffff",
        icon="⚡",
        gpa_range="< 2.0",
        description="Sinh viên thuộc nhóm có kết quả học tập đáng lo ngại. GPA thấp, nhiều môn chưa đạt, nguy cơ bị cảnh báo học tập hoặc buộc thôi học nếu không can thiệp kịp thời.",
        reasons=[
            "GPA dưới 2.0 – dưới mức yêu cầu tối thiểu",
            "Số môn trượt (điểm gốc < 4.0/10) ở mức cao",
            "Điểm số biến động lớn, thiếu ổn định",
            "Không có hoặc rất ít môn học xuất sắc",
        ],
        suggestions=[
            "Gặp ngay cố vấn học tập để được hỗ trợ kịp thời",
            "Đăng ký học lại các môn chưa đạt trong kỳ tới",
            "Xây dựng lại phương pháp học tập phù hợp",
            "Cân nhắc hỗ trợ tâm lý nếu có khó khăn ngoài học tập",
        ],
    ),
    ClusterProfile(
        cluster=0,
        label="Trung Bình – Cần Cố Gắng",
        risk="⚠️  Rủi ro trung bình",
        color_tag="warning",
        badge_bg="#f59e0b",
        badge_fg="#1c1917",
        icon="📘",
        gpa_range="2.0 – 2.5",
        description="Sinh viên đạt mức trung bình, vượt ngưỡng an toàn nhưng chưa nổi bật. Điểm còn phân tán, một số môn cần cải thiện thêm để tránh rủi ro học vụ.",
        reasons=[
            "GPA trong khoảng 2.0 – 2.5",
            "Còn một số môn trượt hoặc điểm thấp cần khắc phục",
            "Điểm số chưa đồng đều giữa các học phần",
            "Chưa có nhiều môn xuất sắc để nâng cao GPA",
        ],
        suggestions=[
            "Xây dựng lịch học đều đặn, ưu tiên môn yếu",
            "Tham gia nhóm học tập, trao đổi bài cùng bạn",
            "Gặp giảng viên để được hướng dẫn thêm ở môn khó",
        ],
    ),
    ClusterProfile(
        cluster=3,
        label="Khá – Tiến Bộ Tốt",
        risk="🔵  Rủi ro thấp",
        color_tag="good",
        badge_bg="#3b82f6",
        badge_fg="#ffffff",
        icon="📈",
        gpa_range="2.5 – 3.2",
        description="Sinh viên có kết quả khá, nắm chắc kiến thức cốt lõi và thể hiện sự tiến bộ ổn định. Với thêm nỗ lực, hoàn toàn có thể tiến lên nhóm xuất sắc.",
        reasons=[
            "GPA trong khoảng 2.5 – 3.2",
            "Rất ít hoặc không có môn trượt",
            "Phần lớn học phần đạt từ khá trở lên",
            "Điểm tương đối ổn định qua các học kỳ",
        ],
        suggestions=[
            "Tập trung nâng điểm các môn còn ở mức trung bình",
            "Đặt mục tiêu GPA tăng thêm 0.2 – 0.3 mỗi kỳ",
            "Tham gia các hoạt động học thuật, seminar",
        ],
    ),
    ClusterProfile(
        cluster=1,
        label="Xuất Sắc – Tiếp Tục Phát Huy",
        risk="✅  Rủi ro thấp",
        color_tag="excellent",
        badge_bg="#10b981",
        badge_fg="#ffffff",
        icon="🏆",
        gpa_range="3.2 – 4.0",
        description="Sinh viên có thành tích xuất sắc, GPA cao và đồng đều trên hầu hết học phần. Đây là nhóm tiềm năng nhất, sẵn sàng cho học bổng và nghiên cứu khoa học.",
        reasons=[
            "GPA từ 3.2 trở lên",
            "Không có môn trượt, điểm đồng đều và ổn định",
            "Nhiều môn đạt điểm xuất sắc (≥ 8.0/10)",
            "Kết quả học tập vượt trội so với toàn khóa",
        ],
        suggestions=[
            "Đăng ký tham gia nghiên cứu khoa học, đề tài bộ môn",
            "Ứng tuyển học bổng trong và ngoài nước",
            "Hỗ trợ và hướng dẫn các bạn trong nhóm học tập",
        ],
    ),
]

# --- fixed values: patterns ------------------------------------------------
COUNT_PATTERNS = [r"(\d+)\s*việc làm", r"(\d+)\s*kết quả", r"Tìm thấy\s*(\d+)"]
PAYLOAD_SCRIPT_ID = "__NEXT_DATA__"

# --- fixed values: demo cohort ---------------------------------------------
# (group, cumulative weight, score mean, score sd, TOEIC mean, TOEIC sd)
COHORT_GROUPS = (
    ("xuat_sac", 0.2, 8.8, 0.4, 700.0, 100.0),
    ("kha", 0.5, 7.5, 0.6, 550.0, 80.0),
    ("trung_binh", 0.8, 6.0, 0.8, 450.0, 70.0),
    ("nguy_hiem", 1.0, 5.0, 0.8, 350.0, 60.0),
)
# in the last group this share of scores comes from N(mean, sd) instead
COHORT_FAIL_SHARE, COHORT_FAIL_MEAN, COHORT_FAIL_SD = 0.4, 3.5, 0.5
COHORT_SUBJECTS = [
    "11401", "17102", "17103", "17200", "17222", "11124", "17206", "17202",
    "17204", "17426", "18101", "24102", "24103", "24202", "29101", "17223",
    "17226", "17422", "17506", "17542", "18401", "17212", "17203", "17225",
    "17427", "17522", "19201", "17224", "17201", "17214", "17434", "17221",
    "17227", "17240", "17423", "19202", "25101",
]
# subject code -> name, the second demo cohort
SUBJECT_NAMES = {
    "18124": "Toán cao cấp",
    "29101": "Kỹ năng mềm 1",
    "17102": "Tin học văn phòng",
    "17104": "Tin học đại cương",
    "17206": "Kỹ thuật lập trình C",
    "17232": "Toán rời rạc",
    "17233": "Cấu trúc dữ liệu và giải thuật",
    "17236": "Lập trình hướng đối tượng",
    "17302": "Kiến trúc máy tính và TBNV",
    "17301": "Kỹ thuật vi xử lý",
    "17303": "Nguyên lý hệ điều hành",
    "17426": "Cơ sở dữ liệu",
    "17506": "Mạng máy tính",
    "17212": "An toàn và bảo mật thông tin",
    "17221": "Xử lý ảnh",
    "17226": "Thị giác máy tính",
    "17234": "Trí tuệ nhân tạo",
    "17314": "Phát triển ứng dụng mã nguồn mở",
    "17332": "Công nghệ Internet of Things",
    "17335": "Lập trình Windows",
    "17340": "Phát triển ứng dụng trên nền web",
    "17423": "Lập trình thiết bị di động",
    "17427": "Phân tích và thiết kế hệ thống",
    "17432": "Nhập môn công nghệ phần mềm",
    "17434": "Phát triển ứng dụng với CSDL",
    "17523": "Java cơ bản",
    "17542": "Tiếp thị trực tuyến",
}
