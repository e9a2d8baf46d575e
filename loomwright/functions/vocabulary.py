"""Vocabularies and patterns. All rule functions take them as parameters; these are the defaults."""

# --- fixed values: ordered labels and the substrings that give them -----------------------
POWERTRAIN = {
    "phev": ["phev", "插电混动", "插电式混合动力", "plug-in hybrid"],
    "bev": ["bev", "纯电", "电动车", "electric vehicle", "ev battery", "动力电池", "充电桩"],
    "hev": ["hev", "混合动力", "混动车", "hybrid", "ima"],
    "ice": ["燃油车", "汽油机", "柴油机", "gasoline", "diesel", "spark plug", "火花塞"],
}
SYSTEM = {
    "charging": ["充电", "充电桩", "charger", "charging", "on-board charger", "obc"],
    "battery": ["动力电池", "高压电池", "蓄电池", "battery", "bms", "soc", "cell voltage"],
    "brake": ["制动", "刹车", "abs", "brake", "caliper", "rotor"],
    "steering": ["转向", "方向机", "助力泵", "eps", "steering", "tie rod"],
    "transmission": ["变速箱", "变速器", "离合器", "档位", "换挡", "transmission", "gearbox", "clutch"],
    "hvac": ["空调", "制冷", "暖风", "压缩机", "冷凝器", "hvac", "a/c", "air conditioning"],
    "engine": ["发动机", "引擎", "点火", "喷油", "怠速", "机油", "engine", "misfire", "injector", "oil pressure"],
    "electrical": ["can总线", "can通信", "线束", "继电器", "保险丝", "短路", "断路", "wiring", "relay", "fuse", "electrical"],
    "chassis": ["悬挂", "减震", "车轮", "轮胎", "轴承", "底盘", "suspension", "wheel bearing", "tire", "tyre"],
    "body": ["车门", "车窗", "天窗", "雨刮", "仪表", "车灯", "door", "window", "sunroof", "wiper", "headlight"],
}
# terms that anchor a text in the domain
DOMAIN_TERMS = [
    "汽车", "车辆", "轿车", "客车", "车主", "行驶", "发动机", "变速箱", "变速器", "方向机", "制动", "刹车", "空调", "轮胎", "蓄电池", "动力电池", "故障码", "诊断仪",
    "车门", "车窗", "后备箱", "中控锁", "门锁", "大灯", "前照灯", "雨刮", "雨刷", "凸轮轴", "曲轴", "连杆", "轴瓦", "正时", "离合器", "离合踏板", "助力泵",
    "档位", "挡位", "挂挡", "换挡", "脱挡", "底盘", "悬架", "减震器", "车身控制", "点火开关", "起动机", "发电机", "火花塞", "喷油器", "节气门", "仪表灯", "里程表",
    "ecu", "bcm", "obd", "can总线", "can通信", "abs", "vin",
    "car", "vehicle", "truck", "engine", "transmission", "gearbox", "brake", "steering", "battery", "clutch", "wheel", "tire", "tyre", "radiator", "alternator", "starter", "motorcycle",
    "camshaft", "crankshaft", "timing belt", "timing chain", "headlight", "wiper", "door lock",
]
# terms that put a text outside
FOREIGN_TERMS = [
    "printed circuit board", "pcb", "solder pad", "arduino", "raspberry pi", "bicycle", "mountain bike", "pedal bike", "garage bill", "legal advice", "insurance claim",
    "insect", "bug remains", "car wash", "detailing wax", "直流母线", "交流滤波器", "值班调控", "换流站", "抽油机", "油井", "接户线", "配电线路", "电网调度", "电厂", "变电站", "绕组接地", "备用排污泵",
]
# a foreign term that doesn't count beside a domain term, and an animal that only counts with wording of pests
EXCUSED_TERM = "pcb"
PEST = r"\bspiders?\b"
PEST_WORDING = r"\b(?:get\s+rid\s+of|remove|kill|poison|fog|infest(?:ed|ation)?|nest(?:ing)?)\b|\b(?:inside|within)\s+(?:my\s+|the\s+)?(?:car|vehicle)\b"
# safety devices put out of action, and power lines rerouted
UNSAFE_CHANGE = r"(?:短接|屏蔽|绕过|拆除|禁用).{0,45}(?:高压互锁|安全联锁)|(?:高压互锁|安全联锁).{0,45}(?:短接|屏蔽|绕过|拆除|禁用)|(?:改线|改接|强制接通).{0,60}(?:充电|高压|动力电池)|(?:充电|高压|动力电池).{0,60}(?:改线|改接|强制接通)|(?i:(?:bypass|disable|defeat).{0,50}high[- ]voltage\s+interlock|high[- ]voltage\s+interlock.{0,50}(?:bypass|disable|defeat))"
# the declared vehicle, wording of ownership before a mention, comparisons, and what may precede a mention at the start
DECLARED_VEHICLE = r"汽车品牌和车型信息\s*[:：]\s*(.+?)(?:(?:,|，)\s*请回答|(?:,|，)|请回答|$)"
NO_BRAND = ["其他", "其他品牌", "未知", "未知品牌"]
OWNED = r"(?:我(?:的|有(?:一辆|一台|一款)?|开的是)|本人(?:的)?|这辆|这台|车型(?:是|为)|车(?:型)?是).{0,8}$"
COMPARED = r"(?:对比|相比|比较|区别|哪个好|哪款好|还是选|和.{0,12}比)"
YEAR_ONLY = r"^(?:\d{2,4}年?(?:款)?)?$"
RISK_TERMS = {
    "risk_brake": ["brake", "制动", "刹车"],
    "risk_lifting": ["jack stand", "jack up", "举升", "千斤顶"],
    "risk_fuel": ["fuel leak", "gasoline leak", "燃油泄漏", "汽油泄漏"],
    "risk_airbag": ["airbag", "安全气囊"],
    "risk_high_voltage": ["high voltage", "高压电", "高压系统", "动力电池"],
}
# patterns counted in a text, by the name of the count
PROCESS_COUNTS = {
    "heading_count": r"故障诊断|诊断过程|诊断排除|诊断与排除|分析诊断|故障分析及排除|故障分析与排除|维修过程|维修方案|处理方法|解决措施|故障排除|检修方法|检修步骤|排除方法|diagnos(?:is|tic)|troubleshoot(?:ing)?|diagnostic procedure",
    "action_count": r"检查|检测|测量|读取|拆检|拆开|拆下|拆卸|松下|调整|清洗|紧固|修复|更换|换掉|连接|断开|拔掉|插入|插上|观察|启动|处理|清理|初始化|激活|清除|设定|复位|编程|匹配|试车|路试|试验|验证|排查|check(?:ed|ing)?|test(?:ed|ing)?|inspect(?:ed|ing)?|measure(?:d|ment|ing)?|read\s+(?:the\s+)?(?:code|dtc)|remove(?:d)?|replace(?:d)?|road\s+test",
    "finding_count": r"发现|显示|测得|读得|表明|确认|判断|可确定|可判断|说明|查明|found|showed|indicated|confirmed|determined",
    "outcome_count": r"恢复正常|故障(?:已|被|得到|彻底)?排除(?:[。.!！]|$)|问题解决|(?:故障|问题|症状|异响)(?:被)?消除|故障解除|症状解除|异响消失|故障消失|症状消失|不再出现|不再发生|未再出现|未再发生|不再异响|不再响|正常工作|路试正常|试车正常|运行正常|resolved|fixed|returned\s+to\s+normal|no\s+longer",
    "measurement_count": r"测量|测得|测隙|电压|电阻|电流|压力|间隙|故障码|数据流|measure(?:d|ment|ing)?|voltage|resistance|current|pressure|clearance|dtc|fault\s+code",
}
NUMBERED_STEP = r"(?m)(?:^|\n)\s*(?:\(?\d{1,2}\)?[、.．)]|[（(]\d{1,2}[）)]|步骤[一二三四五六七八九十\d]+)|(?<![\d.])(?:[（(]\d{1,2}[）)]|\d{1,2}[、．])(?!\d)"
# families of literals, in the order in which they are taken: (pattern, ignore case)
LITERAL_FAMILIES = [
    (r"\b[PCBU][0O0-9A-F][0-9A-F]{3,5}\b", True),
    (r"(?<![A-Za-z0-9])\d+(?:\.\d+)?\s*(?:mV|V|mA|A|Ω|ohms?|bar|kPa|MPa|psi|rpm|r/min|km/h|km|公里|mm|cm|m|L|mL|升|毫升|Nm|N·m|%|℃|°C|度|年|个月|月|周|天|小时|分钟|秒|万元|元)(?![A-Za-z])", True),
    (r"(?<!\d)(?:19|20)\d{2}(?:年|款)?(?!\d)", False),
    (r"(?<!\d)\d{2}(?:年|款)(?!\d)", False),
    (r"\b(?:[A-Z]{1,5}[-/]?\d{2,}[A-Z0-9/-]*|\d+[A-Z]{1,5}\d+[A-Z0-9/-]*)\b", True),
    (r"(?<![\d.])\d+(?:\.\d+)?\s*万\s*(?:km|公里)", True),
    (r"(?<![A-Z0-9])\d{1,2}W[- ]?\d{2}(?![A-Z0-9])", True),
    (r"(?<!\d)(?:89|9\d|10[0-2])号(?:汽油)?", False),
]
FAULT_CODE = r"^[PCBU][0O0-9A-F][0-9A-F]{3,5}$"
# ------------------------------------------------------------------------------------------

# --- fixed values: wording by which an answer leans on something it doesn't contain ----------
SUBSTANTIVE = r"\b(?:check|test|inspect|measure|replace|remove|install|because|therefore|voltage|resistance|diagnos|fault|engine|battery|brake)\b|检查|检测|测量|更换|拆卸|安装|因为|因此|故障|电压|电阻"
IMAGE = r"\b(?:images?|pictures?|photos?|diagrams?)\b|\bthe\s+figure\b|\bfigure\s+\d+\b|图中|下图|上图|图片|照片|示意图"
IMAGE_IDIOM = r"\bout\s+of\s+the\s+picture\b|\bif\s+you\s+can\s+picture\b|\bpicture\s+(?:this|a)\b"
IMAGE_ASKED_BROAD = r"\b(?:what|which)\s+(?:is|are)\s+(?:the\s+)?(?:name\s+of\s+)?(?:this|these)\b|\b(?:is|are|can)\b.{0,35}\b(?:this|these)\b|\bidentify\b.{0,40}\b(?:part|component|item)\b|这是什么|哪个部件|识别.{0,12}(?:部件|零件)"
IMAGE_ASKED_ATTACHED = r"\b(?:this|these)\b.{0,45}\b(?:came|fell|broke)\s+off\b|\b(?:what|which)\b.{0,35}\b(?:part|component|connector|item|piece|bolt|nut|hose|wire|box|container|device)\b.{0,25}\b(?:this|these)\b|\bwhat\s+(?:is|are)\s+(?:this|these)\s+(?:part|component|connector|item|piece|box|container|device)\b"
IMAGE_ASKED = r"\b(?:what|which|identify|called|name|part|component|connector|colour|color|damage|safe|where|this|these)\b|什么|哪个|识别|部件|零件|损伤|安全吗|位置"
IMAGE_POINTED = r"\b(?:the|this)\s+(?:arrow|circled|pictured)\b|\b(?:shown|pictured)\s+(?:above|below)\b|图中(?:箭头|圈出|所示)|箭头所示|圈出的"
IMAGE_STRONG = r"\b(?:from|based\s+on|judging\s+from|according\s+to)\s+(?:the\s+|this\s+|your\s+)?(?:images?|pictures?|photos?)\b|\blooking\s+at\b.{0,30}\b(?:image|picture|photo)\b|\b(?:image|picture)\s+(?:doesn't|does\s+not)\s+show\b|\bfrom\s+what\s+i\s+can\s+see\b|\bpicture\s*\d+\b|\bmarked\s+(?:with|as)\b|\b(?:combining|using)\b.{0,30}\b(?:image|picture|photo)\b|\b(?:image|picture|photo)\b.{0,80}\b(?:that|it|this)\s+looks?\s+like\b|根据(?:图|图片)|从图中|图中可见"
IMAGE_SHOWS = r"\b(?:image|picture)\s+(?:shows|contains|is|describes|depicts)\b|\bin\s+(?:the|this|your|these|first|second|third)\s+(?:image|picture|photo)\b|\b(?:image|picture|photo)\s+(?:above|below)\b|\bshown\s+(?:above|below)\b"
LINK_DIRECTS = r"\b(?:see|read|follow|visit|refer to|check)\b.{0,50}\b(?:link|url|website|page)\b|\b(?:here(?:'s|\s+is)|this)\b.{0,35}\b(?:video|website|pdf|link|page|article|post|thread|manual|instructions?)\b|\b(?:video|website|page|article|post|thread|manual)\b.{0,35}\b(?:shows|tells|lists|explains|describes)\b|\bgo\s+to\b.{0,45}\b(?:website|page|link|url)\b|\bif\s+it\s+(?:sounds|looks)\s+like\s+this\b|详见链接|参见链接|访问链接"
LINK_FULFILS = r"\b(?:video|website|page|manual|article|post|thread)\b.{0,70}\b(?:complete\s+procedure|whole\s+procedure|including\s+the\s+location|where\s+it\s+is|obtain\s+the|retrieve\s+the|gives?\s+the\s+answer)\b|\bonly\s+answering\s+where\b.{0,120}\bvideo\b"
ACTIONS_TOLD = r"\b(?:check|test|inspect|measure|replace|remove|install|diagnos)\w*\b|检查|检测|测量|更换|拆卸|安装|诊断"
COMMENT = r"\bcomments?\b|评论中|评论区"
COMMENT_NEEDED = r"\b(?:see|read|check|refer to)\b.{0,40}\bcomments?\b|\bfollowing\s+(?:the\s+)?link\s+in\s+(?:this|the)\s+comment\b|as\s+(?:described|explained)\s+in\s+(?:the\s+)?comments?|详见评论|参见评论"
OTHER_ANSWER = r"\b(?:other|another|accepted|previous)\s+answer\b|其他回答|采纳的回答"
OTHER_ANSWER_NEEDED = r"\b(?:see|read|refer to)\b.{0,50}\b(?:other|another|accepted|previous)\s+answer\b|答案同(?:上|其他回答)|详见其他回答"
BYPASS_WORD = r"\bbypass\b|绕过|屏蔽|短接"
BYPASS_HARMLESS = r"屏蔽(?:线|层|电缆)"
BYPASS_ACTION = r"\b(?:bypass|disable|defeat|override|jump)\b|绕过|禁用|屏蔽|短接|拆除"
BYPASS_OBJECT = r"\b(?:safety\s+(?:system|switch|interlock)|interlock|speed\s+limiter|governor|airbag|emissions?\s+(?:system|control)|parking\s+brake|seat\s*belt|video\s+lock|immobilizer|high[- ]voltage\s+interlock)\b|安全装置|安全联锁|速度限制|限速器|驻车制动|安全气囊|排放控制|高压互锁"
BYPASS_TOLD = r"\b(?:how\s+(?:to|can|do)|you\s+can|you\s+should|try\s+to|need\s+to|must|as\s+follows|instructions?|procedure|simply)\b|如何|怎么|可以|可将|需要|步骤"
CASE_WORDING = r"一辆|一台|该车|本车|进厂|进店|送修|车主反映|故障现象|行驶里程|维修案例|经检查"
UPKEEP_WORDING = r"保养|维护|库存电池|存放|定期充电"
# ---------------------------------------------------------------------------------------------

# --- fixed values: wording of answers that breaks a rule, and what excuses it ------------------
ANSWER_META = r"证据|候选(?:Evidence)?|检索结果|同类系统|类似案例|参考案例|不能直接套用|不可直接套用|迁移(?:检查|方法|结论)|作为排查参考"
REASON_ONLY_SIMILAR = r"(?:仅|只是).{0,12}(?:类似|相似)|(?:采用|属于|应走|按).{0,8}(?:类比|analogy)|(?:车型|主要现象|触发工况).{0,12}(?:明显)?(?:不同|不一致|不匹配)"
REASON_REUSES = r"(?:采用|选择|判定为|按).{0,8}(?:类比|analogy)|可(?:以)?迁移|(?:能够|适合|尝试)迁移.{0,8}(?:检查|方法|思路)|故选(?:择)?为?.{0,4}(?:类比|analogy)|可(?:以)?复用|(?:采用|借用).{0,20}(?:证据|检查|方法|原则|思路)"
REASON_DENIES = r"(?:无|不|未|缺乏|不能|不可|无法).{0,8}$"
REASON_MATCHES = r"(?:系统|主要现象|触发工况).{0,20}(?:完全|高度).{0,5}(?:一致|匹配)|(?:完全|高度).{0,8}(?:一致|匹配).{0,12}(?:直接采用|matched)"
ANSWER_PROCEDURE = r"拆(?:下|卸|开)|拔(?:下|出|掉)|短接|跨接|泄压|打磨|恢复出厂|刷写|重装系统|松开.{0,12}螺栓|断开.{0,12}(?:蓄电池|电瓶|高压|线束|插头)|用(?:万用表|试灯|缸压表|压力表|诊断仪)"
PROFESSIONAL = r"专业|技师|维修人员|维修店|维修点|服务中心|授权|具备资质"
ACTION_NEGATED = r"(?:(?:不要|切勿|严禁|不得|避免|不建议|禁止|无需|不必|不可|不能|请勿|不应|无法(?:提供|确定|给出)?).{0,24}|[不未])$"
ACTION_QUERIED = r"(?:是否|有没有|有无|是否已经|当前是否|之前是否|是否已).{0,20}$"
ACTION_RISKY = r".{0,12}(?:涉及|存在|可能造成).{0,16}(?:风险|危险|受伤|损坏)"
ACTION_WONDERED = r".{0,18}(?:是为了|原因).{0,32}(?:还是|是否)"
ACTION_HARMLESS = r"拔出.{0,6}机油尺|抽出.{0,6}机油尺"
ACTION_DANGEROUS = r"(?:靠近.{0,12}(?:排气管|尾气).{0,8}闻|闻(?:一下)?(?:尾气|排气|排气管气味))|(?:(?:堵住|夹住|捏住).{0,12}(?:真空管|进气管|管路))|(?:(?:串联|电流档).{0,30}(?:万用表|表笔|回路))|(?:断开.{0,12}(?:电瓶|蓄电池).{0,40}(?:串联|电流档|表笔))|(?:向(?:气缸|缸内).{0,12}(?:加|注入).{0,8}机油)|(?:拆检.{0,8}(?:缸盖|气门|高压系统|制动系统|转向系统))"
RISKY_DRIVING = r"LCC|辅助驾驶|智能驾驶|智驾|幽灵刹车|ABS|制动|刹车|转向失灵|方向失控"
ROAD_TEST = r"(?:试车|路试|低速行驶|驾驶|驶过|通过).{0,20}(?:减速带|坑洼|湿滑|急刹|复现|测试)|(?:录像|拍摄).{0,20}(?:行驶|故障发生|路况)"
ROAD_SAFE = r"安全|空旷|停车场|不影响交通|低速|短时间|不要长时间|停止|立即停止|异常加剧|警告灯|具备资质|专业人员"
ROAD_DANGEROUS = r"高速|急刹|紧急制动|失控|甩尾|打滑|持续.{0,8}(?:打死|极限)|反复.{0,8}(?:急刹|紧急制动)"
FLUID_ASKED = r"(?:加|用|换).{0,8}(?:什么|哪种|哪一类)油|应该加什么油"
FLUID_NAMED = r"机油|汽油|柴油|燃油|变速箱油|齿轮油|刹车油|制动液|冷却液|防冻液|助力油"
FLUID_FUEL = r"汽油|柴油|燃油"
CAUSE_NAMED = r"常见(?:原因|方向)|通常(?:指向|由于|与|是|指|表示|代表)|多半(?:是|来自)|可能(?:是|由|涉及|来自|与).{0,50}(?:故障|损坏|磨损|堵塞|异常|不良|问题|有关|相关|导致|引起)|(?:原因|故障点)(?:包括|有|为)"
CLAIM_UNSOURCED = r"(?:通常|一般|往往|多数情况下|普遍).{0,50}(?:是|会|可|能|指|表示|代表|做工|意味着|说明|需要|取决于)"
# ---------------------------------------------------------------------------------------------
