"""Word lists of the text queries; callers may give their own."""

# Words of finance, words of other news, categories, and what tells kinds of relevance apart.
FINANCIAL = [
    "cổ phiếu", "mã chứng khoán", "vn-index", "hnx-index", "upcom", "thanh khoản", "khối ngoại", "tự doanh", "lợi nhuận", "doanh thu",
    "báo cáo tài chính", "kết quả kinh doanh", "cổ tức", "phát hành", "trái phiếu", "nợ vay", "m&a", "sáp nhập", "lãi suất", "tỷ giá",
    "tín dụng", "nợ xấu", "ngân hàng nhà nước", "lạm phát", "gdp", "cpi", "bất động sản", "đầu tư công", "xuất khẩu", "giá thép", "giá dầu",
    "định giá", "khuyến nghị", "mua ròng", "bán ròng", "pháp lý", "thi hành án", "điều tra", "khởi tố", "vàng", "hàng hóa",
]
NOISE = ["túi hermès", "túi hermes", "xe sang", "đại gia", "showbiz", "hoa hậu", "ca sĩ", "diễn viên", "đời sống", "du lịch", "ẩm thực", "lifestyle"]
GOOD = ["thi_truong_chung_khoan", "doanh_nghiep", "ngan_hang", "bao_cao_phan_tich"]
MEDIUM = ["bat_dong_san", "vi_mo", "tai_chinh_quoc_te", "thi_truong"]
MACRO = ["lãi suất", "tỷ giá", "cpi", "gdp", "ngân hàng nhà nước", "lạm phát"]
COMMODITY = ["giá dầu", "giá thép", "vàng", "hàng hóa"]
LEGAL = ["pháp lý", "thi hành án", "điều tra", "khởi tố", "trái phiếu", "ngân hàng"]

# The aspects and their words.
ASPECTS = {
    "business_financials": [
        "doanh thu", "lợi nhuận", "lãi ròng", "lãi sau thuế", "lãi trước thuế", "lãi gộp", "biên lợi nhuận", "biên gộp", "eps", "roe", "roa", "ebitda",
        "dòng tiền", "lưu chuyển tiền", "cash flow", "tiền mặt", "chi phí", "chi phí đầu vào", "giá vốn", "biên lãi", "core kinh doanh", "mảng kinh doanh", "hoạt động kinh doanh",
        "hợp đồng mới", "gói thầu", "trúng thầu", "đơn hàng", "backlog", "mở rộng quy mô", "mở rộng công suất", "công suất", "nhà máy mới", "dự án mới", "khai trương", "vận hành",
        "sản lượng", "tiêu thụ", "xuất khẩu", "tăng trưởng", "kết quả kinh doanh", "báo cáo tài chính", "bctc",
    ],
    "leadership_insider": [
        "ban lãnh đạo", "lãnh đạo", "chủ tịch", "phó chủ tịch", "tổng giám đốc", "phó tổng giám đốc", "ceo", "cfo", "thành viên hđqt", "hội đồng quản trị", "hđqt", "ban kiểm soát",
        "bổ nhiệm", "miễn nhiệm", "từ nhiệm", "thay đổi nhân sự", "nhân sự cấp cao", "người nội bộ", "cổ đông nội bộ", "giao dịch nội bộ", "đăng ký mua", "đăng ký bán", "mua vào", "bán ra",
        "thoái vốn của lãnh đạo", "con trai chủ tịch", "con gái chủ tịch", "vợ chủ tịch", "người liên quan",
    ],
    "macro_policy": [
        "vĩ mô", "chính sách", "chính sách ngành", "ngân hàng nhà nước", "nhnn", "bộ tài chính", "chính phủ", "quốc hội", "nghị định", "thông tư", "quy định", "lãi suất", "hạ lãi suất",
        "tăng lãi suất", "tỷ giá", "usd", "vnd", "ngoại hối", "lạm phát", "cpi", "gdp", "pmi", "tăng trưởng tín dụng", "room tín dụng", "đầu tư công", "giải ngân", "thuế", "thuế quan",
        "xuất nhập khẩu", "fdi", "giá dầu", "giá thép", "giá vàng", "giá hàng hóa", "fed", "trung quốc", "mỹ", "địa chính trị",
    ],
    "capital_structure": [
        "cấu trúc vốn", "vốn điều lệ", "tăng vốn", "huy động vốn", "phát hành", "phát hành thêm", "chào bán", "chào bán riêng lẻ", "phát hành riêng lẻ", "quyền mua", "pha loãng", "cổ tức",
        "trả cổ tức", "chia cổ tức", "tạm ứng cổ tức", "cổ phiếu thưởng", "mua cổ phiếu quỹ", "bán cổ phiếu quỹ", "cổ phiếu quỹ", "trái phiếu", "trái phiếu chuyển đổi", "nợ vay", "vay nợ",
        "dư nợ", "đáo hạn", "tái cơ cấu nợ", "room ngoại", "sở hữu nước ngoài", "free float",
    ],
    "legal_esg": [
        "pháp lý", "rủi ro pháp lý", "tuân thủ", "khởi tố", "bị khởi tố", "điều tra", "bị điều tra", "bắt tạm giam", "tạm giam", "truy tố", "xét xử", "thi hành án", "cưỡng chế", "phong tỏa",
        "kê biên", "xử phạt", "phạt tiền", "vi phạm", "sai phạm", "thanh tra", "kiểm tra", "kiểm toán", "hủy niêm yết", "đình chỉ giao dịch", "hạn chế giao dịch", "cảnh báo", "kiểm soát",
        "kiểm soát đặc biệt", "tranh chấp", "kiện", "khởi kiện", "tố cáo",
        "esg", "môi trường", "xả thải", "ô nhiễm", "cháy nổ", "tai nạn lao động", "đình công", "ngừng việc", "lao động", "an toàn lao động", "phát thải", "carbon", "quản trị công ty", "minh bạch",
    ],
}
# Words that weigh two more in the aspect of law.
LEGAL_STRONG = [
    "khởi tố", "bị khởi tố", "điều tra", "bị điều tra", "bắt tạm giam", "tạm giam", "truy tố", "xét xử", "thi hành án", "cưỡng chế", "phong tỏa", "kê biên", "xử phạt", "vi phạm", "sai phạm",
    "xả thải", "ô nhiễm", "đình công",
]
