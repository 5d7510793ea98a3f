from rainloom.operators.prepare.chained import ChainedImputer, fit_chained_imputer
from rainloom.operators.prepare.dictionary import WideEncoder, category_dictionary, fit_wide_one_hot
from rainloom.operators.prepare.encoding import (
    fit_one_hot, fit_target_encoding, mode_impute, most_frequent, target_encode, target_encode_oof,
)
from rainloom.operators.prepare.imputation import (
    GaussianImputer, fit_gaussian_imputer, mean_impute, missing_indicator,
)
from rainloom.operators.prepare.preparation import Preparation, Preprocessor, build_preprocessor, fit_preparation
from rainloom.operators.prepare.scaling import RobustScale, fit_robust_scale

__all__ = [
    "ChainedImputer", "GaussianImputer", "Preparation", "Preprocessor", "RobustScale", "WideEncoder", "build_preprocessor",
    "category_dictionary",
    "fit_chained_imputer", "fit_gaussian_imputer", "fit_one_hot",
    "fit_preparation", "fit_robust_scale", "fit_target_encoding", "fit_wide_one_hot", "mean_impute", "missing_indicator",
    "mode_impute", "most_frequent", "target_encode", "target_encode_oof",
]
