"""Results of the baseline run (50,000 applications), as printed."""

import csv
import io

ROWS = """
application_id,application_date,product_type,score_band,credit_score,annual_income,debt_to_income_ratio,utilization_rate,tradeline_count,months_since_oldest_trade,recent_inquiry_count,delinquency_count_12m,major_derogatory_flag,bankruptcy_flag,prequalified_flag,returning_customer_flag,requested_amount,loan_term_months,base_apr_for_payment_calc,monthly_payment_proxy,payment_to_income_ratio,amount_to_income_ratio,base_pd,mult_delinq,mult_derog,mult_bankruptcy,mult_util,mult_dti,mult_inquiry,mult_tradeline,mult_file_age,mult_pti,mult_amt_income,mult_product,estimated_pd,estimated_lgd,expected_loss_amount
APP-00000001,2025-07-02,REVOLVING_LINE,PRIME,702,143421.83,0.1722,0.2593,6,129,3,0,false,false,false,true,29862.39,,0.216176,895.87,0.074957,0.208214,0.025000,1.00,1.00,1.00,1.00,0.95,1.05,1.00,1.00,1.00,1.03,1.12,0.028597,0.850000,725.88
APP-00000002,2025-06-15,MORTGAGE,DEEP_SUBPRIME,534,66567.94,0.4861,0.8132,4,43,5,2,false,false,true,false,97410.31,180,0.100000,1046.78,0.188700,1.463322,0.260000,1.45,1.00,1.00,1.45,1.25,1.12,1.05,1.05,1.25,1.25,0.90,0.450000,0.200000,8766.93
APP-00000004,2025-08-21,AUTO_LOAN,SUPER_PRIME,761,181071.90,0.3441,0.0919,6,260,3,0,false,false,false,true,10801.14,48,0.056441,251.91,0.016695,0.059651,0.010000,1.00,1.00,1.00,0.95,1.00,1.05,1.00,1.00,0.95,1.00,1.00,0.009742,0.450000,47.35
APP-00000014,2025-06-12,HELOC,SUPER_PRIME,815,130849.99,0.3510,0.1594,10,188,2,0,false,false,true,false,159608.75,120,0.087782,1167.56,0.107075,1.219784,0.010000,1.00,1.00,1.00,1.00,1.10,1.05,1.00,1.00,1.10,1.25,0.95,0.015117,0.250000,603.20
APP-00000016,2025-10-06,UNSECURED_PERSONAL_LOAN,PRIME,724,192895.15,0.4681,0.1777,5,130,3,0,false,false,true,true,23046.05,48,0.124187,611.64,0.038050,0.119474,0.025000,1.00,1.00,1.00,1.00,1.25,1.05,1.05,1.00,0.95,1.03,1.10,0.035729,0.700000,576.39
"""

PRODUCT_MIX = """
product_type,applications,pct_of_total
MORTGAGE,15065,30.13
REVOLVING_LINE,12455,24.91
AUTO_LOAN,9946,19.89
UNSECURED_PERSONAL_LOAN,7572,15.14
HELOC,4962,9.92
"""

BAND_MIX = """
score_band,applications,pct_of_total
SUPER_PRIME,8984,17.97
PRIME,13987,27.97
NEAR_PRIME,12073,24.15
SUBPRIME,8902,17.80
DEEP_SUBPRIME,6054,12.11
"""

VARIABLE_PROFILE = """
variable_name,n,min_val,p25,median,mean,p75,max_val,std_dev
amount_to_income_ratio,50000,0.0066,0.1756,0.4289,1.1480,2.0069,8.8432,1.3314
annual_income,50000,20012.22,81490.85,118422.23,121951.93,162535.36,239997.79,51567.05
base_apr_for_payment_calc,50000,0.0503,0.0929,0.1179,0.1456,0.2053,0.3500,0.0704
credit_score,50000,500.00,623.00,689.00,684.23,744.00,850.00,84.74
debt_to_income_ratio,50000,0.0801,0.3114,0.3887,0.3941,0.4690,0.7000,0.1127
estimated_lgd,50000,0.2000,0.2000,0.4500,0.4923,0.7000,0.8500,0.2652
estimated_pd,50000,0.0084,0.0315,0.0877,0.1679,0.3359,0.4500,0.1699
expected_loss_amount,50000,9.55,619.89,2198.52,4919.61,6794.45,60730.15,6568.13
monthly_payment_proxy,50000,23.71,546.95,967.08,1522.70,1925.15,10275.96,1520.11
months_since_oldest_trade,50000,6.00,66.00,110.00,121.27,170.00,307.00,68.76
payment_to_income_ratio,50000,0.0022,0.0549,0.1127,0.1651,0.2591,1.3265,0.1419
recent_inquiry_count,50000,0.00,1.00,2.00,2.34,4.00,6.00,1.72
requested_amount,50000,1000.00,20741.44,46901.73,134916.33,183517.63,1150399.05,188142.16
tradeline_count,50000,1.00,6.00,8.00,8.60,11.00,25.00,4.12
utilization_rate,50000,0.0000,0.2598,0.3812,0.4003,0.5310,0.9500,0.1880
"""

BAND_PROFILE = """
score_band,applications,pct_of_total,avg_credit_score,avg_income,median_income,avg_dti,avg_utilization,avg_tradeline_count,avg_file_age_months,avg_recent_inquiries,avg_delinquency_count,major_derog_rate,bankruptcy_rate,avg_pti,avg_amount_to_income,avg_pd,avg_expected_loss
SUPER_PRIME,8984,17.97,805.10,168523.48,173118.82,0.2943,0.2038,12.04,177.48,1.50,0.07,0.0057,0.0000,0.1291,1.1220,0.0136,705.60
PRIME,13987,27.97,729.55,142758.55,147112.77,0.3448,0.2994,10.35,145.12,2.02,0.20,0.0189,0.0013,0.1477,1.1494,0.0401,1835.22
NEAR_PRIME,12073,24.15,669.58,117696.83,119583.34,0.4045,0.4237,7.78,113.92,2.51,0.66,0.0451,0.0127,0.1692,1.1488,0.1314,5044.71
SUBPRIME,8902,17.80,609.18,87270.34,88162.20,0.4657,0.5502,6.18,81.38,3.03,1.58,0.1059,0.0354,0.1884,1.1534,0.3822,10742.83
DEEP_SUBPRIME,6054,12.11,539.69,64252.29,63960.57,0.5298,0.6575,4.63,56.09,2.97,2.57,0.1802,0.0563,0.2159,1.1736,0.4497,9487.03
"""

PRODUCT_PROFILE = """
product_type,applications,pct_of_total,avg_requested_amount,median_requested_amount,avg_apr,median_apr,avg_monthly_payment,median_monthly_payment,avg_pti,median_pti,avg_pd,avg_lgd,avg_expected_loss,total_expected_loss
AUTO_LOAN,9946,19.89,43467.15,43353.34,0.1118,0.1008,1012.54,970.28,0.1258,0.0973,0.1626,0.4500,3105.61,30888381.91
HELOC,4962,9.92,140524.89,140899.11,0.1186,0.1172,1395.81,1349.66,0.1777,0.1337,0.1760,0.2500,6072.82,30133330.11
MORTGAGE,15065,30.13,344327.00,293162.76,0.0875,0.0946,3016.93,2609.42,0.2982,0.3146,0.1777,0.2000,8881.24,133795890.58
REVOLVING_LINE,12455,24.91,17306.21,17543.13,0.2468,0.2355,519.19,526.29,0.0611,0.0529,0.1577,0.8500,2202.76,27435422.76
UNSECURED_PERSONAL_LOAN,7572,15.14,28179.14,28394.55,0.1570,0.1462,953.76,929.50,0.1144,0.0925,0.1665,0.7000,3133.55,23727273.00
"""

PTI_BUCKETS = """
pti_bucket,applications,pct_of_total,avg_monthly_payment,avg_requested_amount,avg_apr,avg_pd,avg_expected_loss
<5%,11031,22.06,333.98,16536.59,0.1734,0.1047,663.62
10%-14%,6904,13.81,1205.75,79418.51,0.1486,0.1635,3461.37
15%-19%,4076,8.15,1585.94,121079.44,0.1377,0.2010,5273.76
20%+,16143,32.29,2979.06,309452.30,0.1111,0.2364,10526.90
5%-9%,11846,23.69,807.97,44410.58,0.1678,0.1245,1969.52
"""


def rows(text: str) -> list[dict[str, str]]:
    return list(csv.DictReader(io.StringIO(text.strip())))
