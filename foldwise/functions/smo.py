"""The dual of a soft-margin SVM with a bias, solved exactly for one bounded group:

    min 1/2 a'Qa - 1'a,  0 <= a <= C,  y'a = 0,  Q = y y' K

by pairs of variables: the first violates the optimality conditions most, the second gives the largest
decrease to second order. It ends when no pair violates them by more than ``tol``.
"""

from __future__ import annotations

import numpy as np

from foldwise.functions.svm import kernel

#: rows up to which the kernel matrix is computed at once; beyond, columns on demand
WHOLE = 2000


class Columns:
    def __init__(self, x: np.ndarray, kind: str, gamma: float, degree: int, coef0: float):
        self.x, self.args = x, (kind, gamma, degree, coef0)
        self.k = kernel(x, x, *self.args) if len(x) <= WHOLE else None
        self.kept: dict[int, np.ndarray] = {}
        self.diag = np.diag(self.k).copy() if self.k is not None else np.concatenate([np.diag(kernel(x[i:i + 512], x[i:i + 512], *self.args)) for i in range(0, len(x), 512)])

    def __getitem__(self, i: int) -> np.ndarray:
        if self.k is not None:
            return self.k[i]
        if i not in self.kept:
            if len(self.kept) > 2000:
                self.kept.clear()
            self.kept[i] = kernel(self.x, self.x[i:i + 1], *self.args)[:, 0]
        return self.kept[i]


def solve(x: np.ndarray, y: np.ndarray, C: float, kind: str = "rbf", gamma: float = 1.0, degree: int = 3, coef0: float = 0.0,
          tol: float = 1e-5, most: int = 10_000_000) -> tuple[np.ndarray, float]:
    """(alpha, rho) for y in -1, 1; the decision is sum(alpha y K) - rho. One class alone gives no support rows."""
    n = len(y)
    a, g = np.zeros(n), -np.ones(n)
    if n == 0 or (y == y[0]).all():
        return a, -float(y[0]) if n else 0.0
    k = Columns(x, kind, gamma, degree, coef0)
    for _ in range(most):
        score = -y * g
        up = ((y > 0) & (a < C)) | ((y < 0) & (a > 0))
        low = ((y > 0) & (a > 0)) | ((y < 0) & (a < C))
        i = int(np.where(up, score, -np.inf).argmax())
        worst = score[i]
        if worst - np.where(low, score, np.inf).min() < tol:
            break
        ki = k[i]
        gap = worst - score
        curve = np.maximum(k.diag[i] + k.diag - 2 * ki, 1e-12)
        j = int(np.where(low & (gap > 0), gap * gap / curve, -np.inf).argmax())
        step = gap[j] / curve[j]
        # y_i a_i rises and y_j a_j falls by the step, both within 0..C
        step = min(step, C - a[i] if y[i] > 0 else a[i], a[j] if y[j] > 0 else C - a[j])
        for t, s in ((i, y[i] * step), (j, -y[j] * step)):
            a[t] = min(max(a[t] + s, 0.0), C)
            if a[t] < 1e-12 * C:
                a[t] = 0.0
            elif a[t] > C * (1 - 1e-12):
                a[t] = C
        g += y * (step * (ki - k[j]))
    else:
        raise RuntimeError(f"the dual did not converge in {most} steps")
    free = (a > 0) & (a < C)
    if free.any():
        rho = float((y * g)[free].mean())
    else:
        score = -y * g
        rho = -float((score[up].max() + score[low].min()) / 2)
    return a, rho
