"""Word lists, tables and patterns that results depend on, and their English stand-ins for
the test tables. Everything here can be replaced by arguments of the functions that use it."""

# Fixed values, stated in natural order.
TARGET_EXTENSIONS = [".hwp", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx", ".pdf", ".txt", ".sql"]
TEXT_EXTENSIONS = [".txt", ".sql", ".md", ".csv", ".log"]
TRACKED_EXTENSIONS = [".hwp", ".hwpx", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx", ".pdf", ".txt", ".md"]

CATEGORIES = [
    ("제안서", ["제안서", "제안", "proposal", "RFP"]),
    ("설계서", ["설계서", "설계", "design", "아키텍처", "architecture"]),
    ("보고서", ["보고서", "보고", "report", "결과보고", "중간보고", "최종보고"]),
    ("소스코드", ["소스", "source", "src", "코드", "code", "개발"]),
    ("매뉴얼", ["매뉴얼", "manual", "가이드", "guide", "사용법", "운영"]),
    ("회의록", ["회의록", "회의", "meeting", "minutes", "협의"]),
    ("시험", ["시험", "테스트", "test", "검수", "검증", "QA"]),
    ("계약", ["계약", "contract", "계약서", "견적", "발주"]),
    ("교육", ["교육", "training", "학습", "과정"]),
]
OTHER_CATEGORY = "기타"

REQUIREMENT_TYPES = ["기능", "비기능-성능", "비기능-보안", "비기능-규제", "비기능-가용성", "데이터", "인터페이스", "운영관리", "제약사항", "기타"]
NO_STRATEGY = "(원문 미기재)"

THEMES = [
    ("인증/로그인", ["로그인", "인증", "sso", "비밀번호", "패스워드", "본인확인", "인증서", "싱글사인온"]),
    ("권한/접근제어", ["권한", "접근통제", "접근 통제", "메뉴권한", "메뉴 권한", "롤", "접근권한"]),
    ("사용자/회원관리", ["회원", "사용자관리", "사용자 관리", "가입", "탈퇴", "회원관리", "사원관리", "조직관리"]),
    ("검색/조회", ["검색", "조회", "찾기", "필터", "검색조건", "검색 조건"]),
    ("통계/리포트/대시보드", ["통계", "리포트", "보고서", "현황", "집계", "그래프", "차트", "대시보드", "분석화면"]),
    ("결재/승인", ["결재", "승인", "반려", "결재선", "전자결재", "상신"]),
    ("게시판/콘텐츠", ["게시판", "공지", "게시물", "자료실", "faq", "q&a", "콘텐츠", "컨텐츠", "게시"]),
    ("파일/문서관리", ["파일", "첨부", "문서관리", "업로드", "다운로드", "문서 관리", "산출물관리"]),
    ("알림/메일/SMS", ["알림", "메일", "이메일", "sms", "문자", "푸시", "발송", "안내메일"]),
    ("코드/기준정보", ["공통코드", "기준정보", "코드관리", "코드 관리", "분류관리", "분류 관리"]),
    ("일정/예약/스케줄", ["일정", "캘린더", "예약", "스케줄", "스케쥴"]),
    ("결제/정산/매출", ["결제", "정산", "매출", "환불", "수납", "과금", "요금", "카드"]),
    ("데이터연계/인터페이스", ["연계", "인터페이스", "eai", "api", "연동", "전송", "타시스템", "타 시스템"]),
    ("데이터이관/마이그레이션", ["마이그레이션", "이관", "데이터변환", "데이터 변환", "적재", "초기데이터"]),
    ("보안/감사/암호화", ["암호화", "보안", "감사", "접근기록", "로그기록", "위변조", "전자서명"]),
    ("성능/가용성/백업", ["성능", "응답시간", "동시접속", "처리량", "이중화", "백업", "복구", "무중단"]),
    ("교육/학습(LMS)", ["강의", "수강", "학습", "과정", "평가", "시험", "출결", "진도", "콘텐츠 학습", "이러닝"]),
    ("통합/포털/메인", ["통합", "포털", "메인화면", "메인 화면", "단일화면", "허브"]),
    ("모바일/반응형", ["모바일", "스마트폰", "반응형", "앱(", "어플"]),
    ("다국어/국제화", ["다국어", "국제화", "영문", "언어선택", "다국어지원"]),
]

REQUIREMENT_WORD = "요구사항"
REQUIREMENT_INCLUDE = ["요구사항정의", "요구사항 정의", "요구사항분석", "요구사항 분석", "요구사항리스트", "요구사항 리스트", "요구사항목록", "요구사항 목록"]
REQUIREMENT_PREFIX = "요구사항정의"
REQUIREMENT_EXCLUDE = ["작성법", "작성방법", "양식", "템플릿", "표준", "질의서", "결과서", "설명서", "샘플", "내부검토", "검토계획", "검토준비", "검토팀", "검토결과", "계획서", "준비서", "점검", "체크", "회의록", "예시"]
REQUIREMENT_EXCLUDE_FOLDERS = ["양식", "템플릿", "표준", "샘플"]

# Patterns. `text.java` gives them the flags that they need here.
YEAR = r"((?:19|20)\d{2})"
PERIOD_FOLDER = r"^\((\d{4})\.(\d{1,2})\s*-\s*(\d{4})\.(\d{1,2})\)\s*(.+)$"
YEARLY_FOLDER = r"^(\d{4})년$"
YEARLY_PREFIX = r"^(\d{4})년"
VERSION = r"ver\.?\s*(\d+(?:\.\d+)*)\s*([a-z]?)"
VERSION_NUMBER = r"[_\-\s]v(\d{2,})"
DATE = r"(20\d{6}|\d{6})"

# Text in a binary file.
READABLE = r"[\uac00-\ud7a3\u3131-\u3163\u3165-\u318e\w\s.,;:!?()\"'-]{5,}"

# Bytes that follow a control character (below 32) in the text of a word-processor paragraph; others: none.
PARAGRAPH_CONTROLS = {9: 6, 10: 14, 11: 14, 15: 14, 16: 14, 17: 14, 18: 14, 19: 14, 20: 14, 21: 14, 22: 14, 23: 14, 30: 14, 31: 14}

# English stand-ins of the same shape, for tables without Korean.
ENGLISH_THEMES = [("access", ["login", "the", "password"]), ("report", ["report", "ing", "chart"]), ("search", ["search", "tion", "filter"]), ("links", ["api", "eau", "transfer"]), ("speed", ["ung", "backup"]), ("lists", ["ción", "board"]), ("rare", ["zzq", "qqz"])]
