import random

import pytest

SYLLABLES = "检 查 测 量 电 阻 压 力 插 头 松 动 更 换 传 感 器 制 动 转 向 里 程 故 障 清 洗 润 滑 复 核 温 度 线 束 水 泵".split()


@pytest.fixture
def invent():
    """Invented texts of a wanted length, the same for the same seed."""

    def text(seed: int, length: int) -> str:
        r = random.Random(seed)
        out = []
        while sum(map(len, out)) < length:
            out.append("".join(r.choice(SYLLABLES) for _ in range(r.randint(4, 12))) + str(r.randint(10, 9999)) + r.choice(",。"))
        return "".join(out)[:length]

    return text
